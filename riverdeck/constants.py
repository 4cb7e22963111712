"""Fixed values shared by every module; all must equal the published definitions."""

# The 52-card domain.
RANKS = ("2", "3", "4", "5", "6", "7", "8", "9", "T", "J", "Q", "K", "A")
SUITS = ("h", "d", "c", "s")
SUIT_NAMES = {"h": "Hearts", "d": "Diamonds", "c": "Clubs", "s": "Spades"}
DECK_SIZE = 52

# Chi-squared critical points by degrees of freedom.
CARD_P05, CARD_P01 = 68.67, 76.15  # df 51
SUIT_P05 = 7.81  # df 3
RANK_P05 = 21.03  # df 12
MIN_REPORT_CARDS = 100

# Verdict texts.
NO_DATA = "No data"
CARD_TEST_NAME = "Card Distribution"
CARD_PASS = "PASS (p > 0.05)"
CARD_MARGINAL = "MARGINAL (0.01 < p < 0.05)"
CARD_FAIL = "FAIL (p < 0.01) - Non-random distribution detected"
SUIT_PASS = "PASS (p > 0.05) - Suits are uniformly distributed"
SUIT_FAIL = "FAIL (p < 0.05) - Suit distribution may be biased"
RANK_PASS = "PASS (p > 0.05) - Ranks are uniformly distributed"
RANK_FAIL = "FAIL (p < 0.05) - Rank distribution may be biased"
PVALUE_PASS = "Distribution is consistent with random expectation (p > 0.05)"
PVALUE_FAIL = "Distribution deviates from random expectation (p <= 0.05)"

# Loyalty tiers, best first: (tier, least monthly rake in micro-units, rakeback %).
TIERS = (
    ("diamond", 2_000_000_000, 20),
    ("platinum", 500_000_000, 15),
    ("gold", 200_000_000, 10),
    ("silver", 50_000_000, 5),
    ("bronze", 0, 0),
)
LOWEST_TIER = "bronze"
RAKE_PER_POINT = 10_000
MICRO_UNITS = 1_000_000
TIER_CHANGE_REASON = "Monthly rake threshold"

# Event types and the attributes they carry (all strings on the wire).
HAND_STARTED = "hand_started"
HAND_COMPLETED = "hand_completed"
ACTION = "action_performed"
JOINED = "player_joined_game"
LEFT = "player_left_game"
ROUTED_TYPES = (HAND_STARTED, HAND_COMPLETED, ACTION, JOINED, LEFT)
ATTRIBUTES = (
    "game_id", "player", "action", "amount", "hand_number", "deck_seed", "deck", "community_cards",
    "revealed_hole_cards", "winner_count", "buy_in_amount", "refund_amount", "block_height",
)
NEW_HAND_ACTION = "new-hand"
SHOWDOWN_ACTIONS = ("show", "muck", "fold")

# Paging and reporting defaults.
PAGE_LIMIT, PAGE_MAX = 50, 1000
PROGRESS_EVERY = 100
TIMELINE_WIDTH = 1000
