"""The session fold on a stream, with the open sessions in the state store.

State per player and game: the sessions open at the settled block, and the moves of the blocks after it. A
batch adds its moves, folds from the settled block on and logs the sessions that changed; what lies at or
below the watermark is then settled, and a key with nothing open and nothing recent has no state. Keys share a
call of Python and an entry of the state store by `_BUCKETS` buckets, so a batch costs as much as its own moves and
what is open in the buckets they fall into, whatever was ever logged.

Moves may come up to `late_blocks` blocks late, in any order and more than once. Later ones are dropped, which
is what a replay of older blocks needs. The newest logged version of a session counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riverdeck.operators.events import session_events
from riverdeck.schemas import SESSIONS
from riverdeck.streaming import logs
from riverdeck.streaming.keyed import by_height, start, with_state

_KEY = ["player_address", "game_id", "join_block"]
#: Players share entries of the state store; fixed for the life of a checkpoint.
_BUCKETS = 2048
_STATE = ("opened array<struct<join_block:bigint,join_seq:int,buy_in:bigint>>, "
          "moves array<struct<height:bigint,event_seq:int,is_join:boolean,amount:bigint>>")


def fold(opened: list[tuple], moves: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Open sessions (join_block, join_seq, buy_in) and ordered moves (height, event_seq, is_join, amount) ->
    the sessions open after them, and those that ended on the way, with leave block and cash-out."""
    held, ended = {block: (block, seq, amount) for block, seq, amount in opened}, []
    done = set()
    for height, seq, is_join, amount in moves:
        if is_join:
            if height not in held and height not in done:  # another join in its block is ignored
                held[height] = (height, seq, amount)
        else:
            ended += [(*session, height, amount) for session in held.values()]
            done.update(held)
            held.clear()
    return list(held.values()), ended


def step(key: tuple, state: tuple | None, rows: list, settled: int) -> tuple:
    """Moves of one player and game: the new state, when it can shrink, and the sessions that changed."""
    opened, recent = ([tuple(x) for x in part] for part in state or ([], []))
    arrived = {row[:2]: row for row in rows}
    moves = sorted((arrived | {move[:2]: move for move in recent}).values())
    before = {session[0] for session in opened}
    held, ended = fold(opened, moves) if rows else ([], [])
    changed = [(*key, block, seq, leave, amount, refund) for block, seq, amount, leave, refund in ended]
    changed += [(*key, block, seq, None, amount, 0) for block, seq, amount in held if block not in before]
    opened, _ = fold(opened, [move for move in moves if move[0] <= settled])
    moves = [move for move in moves if move[0] > settled]
    if not opened and not moves:
        return None, None, changed
    return (opened, moves), moves[-1][0] if moves else None, changed


def changed_sessions(events: DataFrame, late_blocks: int = 0) -> DataFrame:
    """A stream of events -> the sessions that each batch opens or ends."""
    moves = by_height(session_events(events), late_blocks)
    key = ["player_address", "game_id"]
    return with_state(moves, key, step, SESSIONS, _STATE, F.pmod(F.xxhash64(*key), F.lit(_BUCKETS)))


def start_sessions(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                   late_blocks: int = 0) -> StreamingQuery:
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        logs.write_batch(batch, out, "sessions", batch_id)
        logs.commit(batch.sparkSession, out, batch_id)

    return start(changed_sessions(events, late_blocks), each_batch, checkpoint, trigger)


def _newest(rows: DataFrame) -> DataFrame:
    return logs.latest(rows, _KEY).select(*SESSIONS.names)


def current_sessions(spark: SparkSession, out: str) -> DataFrame:
    """All sessions, ended or open, as last logged."""
    return _newest(logs.read_log(spark, out, "sessions", SESSIONS))


def compact_sessions(spark: SparkSession, out: str) -> None:
    """The newest version of each session logged so far, in one base. Batches read no log, so one that runs
    again does not miss what was merged."""
    logs.compact(spark, out, "sessions", SESSIONS, _newest)
