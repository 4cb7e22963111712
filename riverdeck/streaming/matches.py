"""Events met by the snapshot of their time, on a stream: hands and showdowns of older chains, kept current.

Snapshots and events are two streams that go on at their own pace. State per game and span of `SPAN` blocks: the newest
snapshot of its settled blocks, the snapshots after them, and the events that may still meet another one. It goes
when the span settles, and no call of Python holds more of a hot game than a span. An event
is answered at once with what is there in its span; if a snapshot that suits it better comes later, it is answered
again, and the newest logged answer counts. A block settles when both streams have passed it, so an event
that runs ahead of the snapshots waits for them, and neither stream needs the other's past.

What a span hands on is its newest snapshot, logged as an answer to no event (event_seq -1); an event that meets
none in its own span takes, when read, what the newest span before it handed on.

Both may come up to `late_blocks` blocks late, in any order and more than once; what comes later is dropped.
Of several snapshots of a game in one block one is chosen by content, as `operators.states` does.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riverdeck.operators.events import explode_cards
from riverdeck.operators.states import (
    HAND_STATE, SHOWDOWN_STATE, first_shown, hands_of, new_hand_requests, results_of, showdown_requests)
from riverdeck.plans.slices import SPAN
from riverdeck.schemas import MATCHES, SNAPSHOT
from riverdeck.streaming import logs
from riverdeck.streaming.keyed import by_height, start, with_state

#: What is asked for: a hand that starts, a showdown.
HAND, SHOWDOWN = 1, 2
_STATE = ("snapshots array<struct<kind:int,height:bigint,choice:bigint,payload:string>>, "
          "waiting array<struct<kind:int,height:bigint,event_seq:int,met:bigint,choice:bigint>>")
_KEY = ["game_id", "height", "event_seq", "kind"]
_HANDED_ON, _SPAN = -1, "_span"


def requests(events: DataFrame) -> DataFrame:
    """Events -> game_id, kind, height, event_seq, snapshot (false), choice, payload."""
    def of(found: DataFrame, kind: int) -> DataFrame:
        return found.select("game_id", F.lit(kind).alias("kind"), "height", "event_seq", F.lit(False).alias("snapshot"),
                            F.lit(0).cast("bigint").alias("choice"), F.lit(None).cast("string").alias("payload"))

    return of(new_hand_requests(events), HAND).unionByName(of(showdown_requests(events), SHOWDOWN))


def answers(states: DataFrame) -> DataFrame:
    """Snapshots -> rows of the same columns, one per kind of request, with what that needs."""
    def of(kind: int, *columns: str):
        payload = ["as_of_block", *columns]
        return F.struct(F.lit(kind).alias("kind"), F.xxhash64(*payload).alias("choice"), F.to_json(F.struct(*payload)).alias("payload"))

    known = states.filter(F.col("game_id").isNotNull() & F.col("as_of_block").isNotNull())
    return known.select("game_id", F.col("as_of_block").alias("height"),
                        F.inline(F.array(of(HAND, *HAND_STATE), of(SHOWDOWN, *SHOWDOWN_STATE)))).select(
        "game_id", "kind", "height", F.lit(-1).alias("event_seq"), F.lit(True).alias("snapshot"), "choice", "payload")


def step(key: tuple, state: tuple | None, rows: list, settled: int) -> tuple:
    """Requests and snapshots of one game: the new state, when it can shrink, and the answers that changed."""
    snapshots, waiting = ([tuple(x) for x in part] for part in state or ([], []))
    best = {(kind, height): (choice, payload) for kind, height, choice, payload in snapshots}
    asked = {(kind, height, seq): (met, choice) for kind, height, seq, met, choice in waiting}
    for kind, height, seq, is_snapshot, choice, payload in rows:
        if is_snapshot:
            if (kind, height) not in best or choice > best[kind, height][0]:
                best[kind, height] = (choice, payload)
        else:
            asked.setdefault((kind, height, seq), None)
    blocks: dict[int, list[int]] = {}
    for kind, height in sorted(best):
        blocks.setdefault(kind, []).append(height)
    changed = []
    for (kind, height, seq), before in sorted(asked.items()):
        at = bisect_right(blocks.get(kind, []), height)
        met = blocks[kind][at - 1] if at else -1
        choice, payload = best[kind, met] if at else (0, None)
        if before != (met, choice):
            asked[kind, height, seq] = (met, choice)
            changed.append((*key, height, seq, kind, met if at else None, payload))
    kept = []
    for kind, heights in blocks.items():  # of the settled blocks the newest snapshot says all
        first = max(0, bisect_right(heights, settled) - 1)
        kept += [(kind, height, *best[kind, height]) for height in heights[first:]]
    waiting = [(*request, *met) for request, met in sorted(asked.items()) if request[1] > settled]
    if not kept and not waiting:
        return None, None, changed
    ahead = [height for _, height, *_ in [*kept, *waiting] if height > settled]
    return (kept, waiting), max(ahead, default=None), changed


def span_step(width: int):
    """`step` within spans of a game: keys are (game, number of the span)."""
    def within(key: tuple, state: tuple | None, rows: list, settled: int) -> tuple:
        game, span = key
        kept, block, changed = step((game,), state, rows, settled)
        if kept is None:
            return None, None, changed
        if any(is_snapshot for _, _, _, is_snapshot, _, _ in rows):
            newest = {kind: (height, payload) for kind, height, _, payload in kept[0]}  # in order of height
            changed += [(game, span * width, _HANDED_ON, kind, *last) for kind, last in newest.items()]
        end = span * width + width - 1
        if end <= settled:
            return None, None, changed
        return kept, end if block is None else block, changed

    return within


def _spans(height: str = "height"):
    return F.floor(F.col(height) / SPAN)


def start_matches(events: DataFrame, states: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                  late_blocks: int = 0) -> StreamingQuery:
    """Log the answers to a stream of events from a stream of snapshots (`sources.blocks.game_states`)."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        logs.write_batch(batch, out, "matches", batch_id)
        logs.commit(batch.sparkSession, out, batch_id)

    both = by_height(requests(events), late_blocks).unionByName(by_height(answers(states), late_blocks))
    changed = with_state(both.withColumn(_SPAN, _spans()), ["game_id", _SPAN], span_step(SPAN), MATCHES, _STATE)
    return start(changed, each_batch, checkpoint, trigger)


def _newest(rows: DataFrame) -> DataFrame:
    return logs.latest(rows, _KEY).select(*MATCHES.names)


def _matched(spark: SparkSession, out: str, kind: int, columns: list[str]) -> DataFrame:
    shape = StructType([SNAPSHOT[c] for c in ("as_of_block", *columns)])
    found = _newest(logs.read_log(spark, out, "matches", MATCHES).filter(F.col("kind") == kind)).withColumn(_SPAN, _spans())
    # A row per game and span; what the spans before it hand on is looked for over those.
    earlier = Window.partitionBy("game_id").orderBy(_SPAN).rowsBetween(Window.unboundedPreceding, -1)
    carried = found.groupBy("game_id", _SPAN).agg(
        F.max(F.when(F.col("event_seq") == _HANDED_ON, F.col("payload"))).alias("_edge")).select(
        "game_id", _SPAN, F.last("_edge", ignorenulls=True).over(earlier).alias("_carried"))
    asked = found.filter(F.col("event_seq") != _HANDED_ON).join(carried, ["game_id", _SPAN], "left")
    return asked.select("game_id", "height", "event_seq", F.from_json(F.coalesce("payload", "_carried"), shape).alias("state"))


def current_legacy_hands(spark: SparkSession, out: str, headers: DataFrame) -> DataFrame:
    """As `operators.states.legacy_hands`, of what has landed."""
    return hands_of(_matched(spark, out, HAND, HAND_STATE), headers)


def current_showdown_results(spark: SparkSession, out: str) -> DataFrame:
    """As `operators.states.showdown_results`."""
    return results_of(_matched(spark, out, SHOWDOWN, SHOWDOWN_STATE))


def current_showdowns(spark: SparkSession, out: str) -> DataFrame:
    """As `operators.states.showdowns`: each card once, at the first block that showed it."""
    return first_shown(explode_cards(current_showdown_results(spark, out), "winner_count"))


def compact_matches(spark: SparkSession, out: str) -> None:
    """The newest answer to each request logged so far, in one base."""
    logs.compact(spark, out, "matches", MATCHES, _newest)
