"""Event attribute decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BASE64 = "^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\\z"
_ATTRIBUTE_NAME = "^[a-z_]+\\z"
_WHOLE_NUMBER = "^[+-]?[0-9]+\\z"
_LONG_MAX, _LONG_MIN = 2**63 - 1, -(2**63)


def _bound(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _unbase64(text: Column) -> Column:
    """The decoded text, or null where `text` is not strict, padded base64 of valid UTF-8."""
    raw = F.when(text.rlike(_BASE64), F.try_to_binary(text, F.lit("base64")))
    return F.try_validate_utf8(raw.cast("string"))


def is_base64_event(attributes: Column) -> Column:
    """Whether every key of the event decodes to an attribute name.

    Single values cannot tell: plain words such as `fold` or `1000` are base64 too."""
    return (F.size(attributes) > 0) & F.forall(
        attributes,
        lambda a: F.coalesce(_unbase64(a["key"]).rlike(_ATTRIBUTE_NAME), F.lit(False)))


def decode_attrs(attributes: Column, encoding: str = "auto") -> Column:
    """Attribute list -> map of strings; the last of repeated keys wins."""
    def decoded(a: Column) -> Column:
        return F.struct(
            F.coalesce(_unbase64(a["key"]), a["key"]).alias("key"),
            F.coalesce(_unbase64(a["value"]), a["value"]).alias("value"))

    def verbatim(a: Column) -> Column:
        return F.struct(a["key"].alias("key"), a["value"].alias("value"))

    listed = F.coalesce(attributes, F.array())
    if encoding == "plain":
        pairs = F.transform(listed, verbatim)
    elif encoding == "base64":
        pairs = F.transform(listed, decoded)
    elif encoding == "auto":
        pairs = F.when(is_base64_event(listed), F.transform(listed, decoded)).otherwise(
            F.transform(listed, verbatim))
    else:
        raise ValueError(f"unknown encoding {encoding!r}")
    pairs = F.filter(pairs, lambda p: p["key"].isNotNull())
    return F.map_from_entries(_bound(pairs, _last_per_key))


def _last_per_key(pairs: Column) -> Column:
    """Keep the last entry of each key, so that building the map cannot meet a duplicate."""
    def last_ones(from_the_end: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(from_the_end)) == F.size(from_the_end), pairs,
        ).otherwise(F.filter(
            pairs,
            lambda p, i: i + F.array_position(from_the_end, p["key"]) == F.size(from_the_end)))

    return _bound(F.reverse(F.transform(pairs, lambda p: p["key"])), last_ones)


def lenient_int(text: Column) -> Column:
    """Whole number in `text`; 0 when missing or malformed, the nearest bound when beyond 64 bits."""
    bound = F.when(text.startswith("-"), F.lit(_LONG_MIN)).otherwise(F.lit(_LONG_MAX))
    return F.when(
        text.rlike(_WHOLE_NUMBER), F.coalesce(text.try_cast("bigint"), bound)).otherwise(F.lit(0)).cast("bigint")


def effective_height(stated: Column, height: Column) -> Column:
    """The height an event states for itself when that parses, else the block it arrived in."""
    return F.coalesce(F.when(stated.rlike(_WHOLE_NUMBER), stated.try_cast("bigint")), height)
