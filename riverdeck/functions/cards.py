"""Card, rank, suit and tier expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from riverdeck.constants import RANKS, SUIT_NAMES, SUITS, TIERS

DECK = [rank + suit for suit in SUITS for rank in RANKS]


def is_standard(card: Column) -> Column:
    """Whether a card is one of the 52: a set lookup, which Parquet dictionaries can answer too."""
    return card.isin(*DECK)


def rank_of(card: Column) -> Column:
    return F.substring(card, 1, 1)


def suit_of(card: Column) -> Column:
    return F.substring(card, 2, 1)


def suit_name(suit: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in SUIT_NAMES.items() for x in pair])[suit]


def rank_weight(rank: Column) -> Column:
    """2 for a deuce up to 14 for an ace: the order ranks are listed in, highest first."""
    return F.array_position(F.array(*[F.lit(r) for r in RANKS]), rank) + 1


def tier_weight(tier: Column) -> Column:
    """1 for the best tier; unknown and missing tiers sort with the lowest."""
    names = F.array(*[F.lit(name) for name, _, _ in TIERS[:-1]])
    place = F.coalesce(F.array_position(names, tier), F.lit(0))
    return F.when(place > 0, place).otherwise(F.lit(len(TIERS)))
