"""Explicit schemas: nothing in the library infers one."""

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from riverdeck.constants import ATTRIBUTES, ROUTED_TYPES


def _record(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


STRING, INT, LONG, STAMP = StringType(), IntegerType(), LongType(), TimestampNTZType()
STRINGS = ArrayType(STRING)

# Landed JSON, one document per line.
EVENT = _record(
    type=STRING, attributes=ArrayType(_record(key=STRING, value=STRING, index=BooleanType())))
BLOCK_RESULTS = _record(result=_record(
    height=STRING,
    txs_results=ArrayType(_record(events=ArrayType(EVENT))),
    begin_block_events=ArrayType(EVENT),
    end_block_events=ArrayType(EVENT)))
BLOCK = _record(result=_record(block=_record(
    header=_record(height=STRING, app_hash=STRING), data=_record(txs=STRINGS))))
CHAIN_STATUS = _record(result=_record(sync_info=_record(latest_block_height=STRING)))
PLAYER = _record(address=STRING, seat=INT, stack=STRING, holeCards=STRINGS, status=STRING)
WINNER = _record(address=STRING, amount=STRING, cards=STRINGS)
GAME_STATE = _record(
    type=STRING, address=STRING, dealer=INT, players=ArrayType(PLAYER), communityCards=STRINGS,
    deck=STRING, round=STRING, handNumber=INT, winners=ArrayType(WINNER))
# A landed snapshot adds what the request knew: the game asked for and the block it was taken at.
LANDED_STATE = _record(game_id=STRING, as_of_block=LONG, game_state=GAME_STATE)

# A decoded event: position in the chain, type, one string column per known attribute.
EVENTS = StructType(
    [StructField("height", LONG), StructField("event_seq", INT), StructField("type", STRING)]
    + [StructField(name, STRING) for name in ATTRIBUTES])

# Fact and summary tables.
TABLES = {
    "poker_hands": _record(
        game_id=STRING, hand_number=INT, block_height=LONG, deck_seed=STRING, deck=STRING,
        tx_hash=STRING, indexed_at=STAMP),
    "hand_results": _record(
        game_id=STRING, hand_number=INT, block_height=LONG, community_cards=STRINGS,
        winner_count=INT, tx_hash=STRING, indexed_at=STAMP),
    "revealed_cards": _record(
        game_id=STRING, hand_number=INT, block_height=LONG, card=STRING, card_type=STRING,
        position=INT, indexed_at=STAMP),
    "card_distribution_stats": _record(
        card=STRING, rank=STRING, suit=STRING, total_appearances=LONG,
        community_appearances=LONG, hole_card_appearances=LONG),
    "player_actions": _record(
        player_address=STRING, game_id=STRING, hand_number=INT, block_height=LONG, action=STRING,
        amount=LONG, round=STRING, indexed_at=STAMP),
    "player_sessions": _record(
        player_address=STRING, game_id=STRING, join_block=LONG, leave_block=LONG,
        buy_in_amount=LONG, cash_out_amount=LONG, hands_played=INT, indexed_at=STAMP),
    "player_monthly_stats": _record(
        player_address=STRING, year=INT, month=INT, hands_played=INT, rake_contributed=LONG,
        net_profit=LONG, vip_points_earned=LONG),
    "vip_tier_history": _record(
        player_address=STRING, old_tier=STRING, new_tier=STRING, reason=STRING, changed_at=STAMP),
    "indexing_progress": _record(last_scanned_block=LONG, total_blocks_scanned=LONG),
}
TIERS = _record(player_address=STRING, vip_tier=STRING)
SESSIONS = _record(
    player_address=STRING, game_id=STRING, join_block=LONG, join_seq=INT, leave_block=LONG,
    buy_in_amount=LONG, cash_out_amount=LONG)

# Stored state of the streams.
HEIGHTS = _record(height=LONG, copies=LONG)
QUARANTINE = _record(file=STRING, reason=STRING, document=STRING)
FIGURES = _record(blocks=LONG, last_height=LONG, seconds=DoubleType(), events=LONG, unreadable=LONG,
                  **{kind: LONG for kind in ROUTED_TYPES})
_ARRIVAL = _record(height=LONG, event_seq=INT)
HAND_PARTIALS = _record(
    game_id=STRING, hand_number=INT, first_at=_ARRIVAL, block_height=LONG, last_at=_ARRIVAL,
    deck_seed=STRING, deck=STRING)
RESULT_PARTIALS = _record(
    game_id=STRING, hand_number=INT, first_at=_ARRIVAL, block_height=LONG, last_at=_ARRIVAL,
    community_cards=STRING, winner_count=INT)
CARD_LOG = _record(
    game_id=STRING, hand_number=INT, block_height=LONG, card=STRING, card_type=STRING, position=INT)
ACTION_LOG = _record(player_address=STRING, game_id=STRING, block_height=LONG, action=STRING, amount=LONG)
PLAYER_TOTALS = _record(player_address=STRING, **dict.fromkeys(
    ("total_actions", "bets", "raises", "calls", "folds", "checks", "allins", "unique_hands", "first_block", "last_block"), LONG))
HAND_BITS = _record(player_address=STRING, game_id=STRING, hands_from=LONG, hands=LONG)
MOVES = _record(
    player_address=STRING, game_id=STRING, height=LONG, event_seq=INT, is_join=BooleanType(), amount=LONG)
SNAPSHOT = _record(
    game_id=STRING, as_of_block=LONG, hand_number=INT, round=STRING, deck=STRING, community=STRINGS,
    players=ArrayType(PLAYER), winners=ArrayType(WINNER))
MATCHES = _record(game_id=STRING, height=LONG, event_seq=INT, kind=INT, met_block=LONG, payload=STRING)
OPEN_HANDS = StructType([*HAND_PARTIALS.fields, StructField("closed", INT)])
