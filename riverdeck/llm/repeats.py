"""Removal of repeated byte strings by longest-previous-factor arrays over a sparse suffix order.

Wanted: each place where a string of `LENGTH` bytes starts that also starts elsewhere. In suffix order such
places stand together; a suffix's longest earlier match is then with the nearest one before or after it in
that order whose position is smaller (previous and next smaller value), its longest later match with the
nearest whose position is larger. Only matches of `LENGTH` bytes or more count, so suffixes are ordered by
their first `LENGTH` bytes, and neighbours that agree in them match.

Not every suffix travels. The string at each place has an anchor, the `GRAM`-byte piece of it with the
smallest hash, so equal strings have equal anchors at equal distance:
1. runs of places with one anchor are one row: the anchor's hash and a keyless BLAKE2 digest (128 bits) of all bytes
   of the run; anchors that occur once are done;
2. runs with one digest are one class: with two members or more, all its places are repeated;
3. classes that share an anchor with another class meet in a task, each with the bytes of its run (at most
   `2 * LENGTH - GRAM`, once per class however often the corpus has it). There their suffixes are put in order
   distance by distance: a string that starts d bytes before the anchor is its first byte and the string that starts
   d - 1 bytes before, so ranks of the left parts follow from those one byte shorter, and ranks of the
   right parts grow by a byte likewise. Ranks come from the bytes themselves: no hash decides about a match. A
   suffix whose part is the only one of its kind leaves the search at once.

An anchor with more than `GROUP` classes is cut up: for the distances of one half, all strings hold the same
stretch around the anchor, so its classes are grouped by that stretch, and so on by halves until a group is small
enough. Classes that agree in all bytes a half can see are decided at once, and one of them goes on.

All places of a run contain its anchor, so what is repeated of a run is one span.

`keep="none"` removes every copy, `keep="first"` all but the earliest by (doc_id, place), null doc_ids last.
Memory per task is a document, or some `GROUP` classes: rows go to Python `BATCH` bytes at a time, and texts that
are only compressed or cut go row by row, so no buffer holds 10,000 texts. Whole texts are shuffled twice, compressed.

Defined cases: a null or empty text has 0 bytes and an empty rest; texts under `LENGTH` bytes lose nothing;
rows equal in doc_id and text are two occurrences under "none" and one under "first"; an empty table gives
an empty result. A span may end inside a character, so the rest is binary. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverdeck.llm.columns import text_or_empty
from riverdeck.llm.shipping import ship
from riverdeck.session import pinned, remove, scratch_path

LENGTH = 400
GRAM = 64
PLACES = 2 ** 17  # places looked at together
INDEX_BITS = np.uint64(20)
ROWS = 50_000  # of a frame that a task hands back
GROUP = 10_000  # classes compared together; a key with more is cut up
STRETCHES = 4 * 2 ** 20  # bytes of stretches that a task hands on together
BATCH = 2 * 2 ** 20  # bytes of rows that a task gets together
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BASE = 0x9E3779B97F4A7C15
LAST = 2 ** 63 - 1


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside the block hand rows to Python `BATCH` bytes at a time; the session gets its own setting back."""
    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, str(BATCH))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    def powers(x: int) -> np.ndarray:
        out = np.full(PLACES + LENGTH + 1, x, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return powers(BASE), powers(pow(BASE, -1, 2 ** 64))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gram_hashes(piece: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes at each place. It only says where anchors lie; nothing is held equal by it."""
    power, inverse = _powers()
    sums = np.zeros(len(piece) + 1, np.uint64)
    np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[:len(piece)], out=sums[1:])
    out = sums[gram:] - sums[:-gram]
    return _mixed(out * inverse[:len(out)], 1)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours: prefix and suffix minima of blocks."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def _chunks(data: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    whole = np.frombuffer(data, np.uint8)
    for first in range(0, len(data) - length + 1, PLACES):
        yield first, whole[first:first + PLACES + length - 1]


def runs(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, digest, bytes before the anchor, first place, last place) of the runs of a text. A run also
    ends at a chunk's end, and its digest says where its anchor lies, so equal digests are equal runs in any case."""
    for first, piece in _chunks(data, length):
        grams = _gram_hashes(piece, gram)
        ranked = (grams >> INDEX_BITS << INDEX_BITS) | np.arange(len(grams), dtype=np.uint64)  # leftmost of equals
        anchor = (_sliding_least(ranked, length - gram + 1) & ((np.uint64(1) << INDEX_BITS) - np.uint64(1))).astype(np.int64)
        low = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        high = np.r_[low[1:], len(anchor)] - 1
        at, seen = anchor[low], memoryview(piece)
        digest = np.empty(len(low), object)
        for k, (start, end, behind) in enumerate(zip(low.tolist(), (high + length).tolist(), (at - low).tolist())):
            digest[k] = hashlib.blake2b(seen[start:end], digest_size=16, salt=behind.to_bytes(4, "little")).digest()
        yield grams[at].view(np.int64), digest, at - low, low + first, high + first


def factors(rank: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order, and per suffix in that order whether it has an earlier and a later match of full length.

    Suffixes of one rank agree in full length and stand together, by position: the previous smaller position of
    each but the first is its neighbour before, the next larger one of each but the last its neighbour after.
    """
    order = np.lexsort((position, rank))
    match = rank[order][1:] == rank[order][:-1]  # the longest common prefix reaches the length
    return order, np.r_[False, match], np.r_[match, False]


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense rank of each value, and how many have it."""
    _, rank, count = np.unique(values, return_inverse=True, return_counts=True)
    return rank, count[rank]


def _aligned(behind: np.ndarray, pieces: list[bytes], length: int, reach: int) -> np.ndarray:
    """A column per piece, a row per byte; anchors start in row `reach`."""
    out = np.zeros((len(pieces), reach + length), np.uint8)
    for row, begin, piece in zip(out, (reach - behind).tolist(), pieces):
        row[begin:begin + len(piece)] = np.frombuffer(piece, np.uint8)
    return np.ascontiguousarray(out.T)


def repeated_distances(group: np.ndarray, behind: np.ndarray, ahead: np.ndarray, pieces: list[bytes], position: np.ndarray,
                       first_stays: bool, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest distance from its anchor at which a string of each piece is repeated in its group;
    -1 where none is. A piece reaches from `behind` bytes before its anchor to `length - ahead` after its start:
    its strings lie at distances `ahead` to `behind`."""
    n, reach = len(pieces), length - gram
    rows = _aligned(behind, pieces, length, reach)
    anchors = np.ascontiguousarray(rows[reach:reach + gram].T).view(f"V{gram}").ravel()
    start, count = _ranked(_ranked(group)[0] * n + _ranked(anchors)[0])
    # Ranks of the parts that start at the anchor, by their length; -1 where it is the only one of its kind.
    right = np.full((reach + 1, n), -1, np.int32)
    longest = np.where(count > 1, gram, 0)
    alive = np.flatnonzero(count > 1)
    right[0, alive] = start[alive]
    for more in range(1, reach + 1):
        alive = alive[reach - ahead[alive] >= more]
        if not alive.size:
            break
        rank, count = _ranked(right[more - 1, alive].astype(np.int64) * 256 + rows[reach + gram + more - 1, alive])
        alive = alive[count > 1]
        right[more, alive] = rank[count > 1]
        longest[alive] = gram + more
    least, largest = np.full(n, -1), np.full(n, -1)
    alive = np.flatnonzero(longest >= length - behind)  # what follows can make up for what stands before
    left = start[alive]
    for distance in range(reach + 1):
        if distance:
            on = behind[alive] >= distance
            alive, left = alive[on], left[on]
            left, count = _ranked(rows[reach - distance, alive].astype(np.int64) * n + left)
            alive, left = alive[count > 1], left[count > 1]
        if alive.size < 2:
            break
        rest = right[reach - distance, alive]
        on = rest >= 0
        if on.any():
            order, earlier, later = factors(left[on] * n + rest[on], position[alive[on]])
            hit = alive[on][order[earlier if first_stays else earlier | later]]
            least[hit] = np.where(least[hit] < 0, distance, least[hit])
            largest[hit] = distance
    return least, largest


def _documents(docs: DataFrame) -> DataFrame:
    payload = F.encode(text_or_empty(), "UTF-8")
    return docs.select("doc_id", payload.alias("payload")).select(
        "doc_id", "payload", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.xxhash64("payload").alias("h1"), F.xxhash64(F.lit("second"), "payload").alias("h2"))


def _runs_of(documents: DataFrame, length: int) -> DataFrame:
    columns = ["anchor", "digest", "behind", "low", "high", "doc", "h1", "h2"]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for batch in batches:
            for data, *ids in zip(batch["payload"], batch["doc"], batch["h1"], batch["h2"]):
                for found in runs(data, length):
                    n = found[0].size
                    out.append((*found, *[np.full(n, i) for i in ids]))
                    size += n
                if size >= ROWS:
                    yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out)))))
                    out, size = [], 0
        if out:
            yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out)))))

    return documents.filter(F.octet_length("payload") >= length).select("doc", "h1", "h2", "payload").mapInPandas(
        emit, "anchor bigint, digest binary, behind int, low bigint, high bigint, doc bigint, h1 bigint, h2 bigint")


STRETCH = "key bigint, run bigint, ahead int, behind int, piece binary"


def _stretches(texts: DataFrame, length: int) -> DataFrame:
    """Texts with their runs to compare -> per run its anchor as key, and its bytes."""
    columns = ["key", "run", "ahead", "behind", "piece"]

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack, out, size = zstandard.ZstdDecompressor(), [], 0
        for batch in batches:
            for packed, *listed in zip(batch["packed"], *[batch[c] for c in ("anchors", "runs", "behinds", "lows", "highs")]):
                data = unpack.decompress(packed)
                for anchor, run, behind, low, high in zip(*listed):
                    out.append((anchor, run, behind - (high - low), behind, data[low:high + length]))
                    size += len(out[-1][-1])
                    if size >= STRETCHES:
                        yield pd.DataFrame(out, columns=columns)
                        out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=columns)

    return texts.mapInPandas(emit, STRETCH)


def _compared(stretches: DataFrame, length: int, gram: int, first_stays: bool) -> DataFrame:
    """(run, least, largest): the distances at which strings of a run are repeated under its key. Two keys that
    meet by chance do no harm, since bytes decide."""
    def settle(held: pd.DataFrame) -> pd.DataFrame:
        run = held["run"].to_numpy()
        least, largest = repeated_distances(held["key"].to_numpy(), held["behind"].to_numpy(np.int64), held["ahead"].to_numpy(np.int64),
                                            list(held["piece"]), run, first_stays, length, gram)
        on = least >= 0
        return pd.DataFrame({"run": run[on], "least": least[on], "largest": largest[on]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = int((held["key"] != held["key"].iloc[-1]).sum()) if len(held) >= GROUP else 0  # whole keys only
            if last:
                yield settle(held.iloc[:last])
                held = held.iloc[last:].reset_index(drop=True)
        if held is not None and len(held):
            yield settle(held)

    return stretches.repartition("key").sortWithinPartitions("key").mapInPandas(
        compare, "run bigint, least int, largest int")


def _halves(level: DataFrame, length: int) -> DataFrame:
    """Each stretch of (key, lo, hi), cut to what the strings at distances lo to middle and beyond it to hi hold, under
    keys of their own: strings at these distances share the bytes from `lo` before the anchor to `length - hi` after."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    half = F.explode(F.array(F.struct(F.col("lo").alias("a"), middle.alias("b")),
                             F.struct((middle + 1).alias("a"), F.col("hi").alias("b"))))
    cut = level.select("*", half.alias("half")).select(
        "key", "run", "piece", F.col("half.a").alias("lo"), F.col("half.b").alias("hi"), F.col("behind").alias("before"),
        F.greatest("ahead", "half.a").alias("ahead"), F.least("behind", "half.b").alias("behind")).filter("ahead <= behind")
    core = F.expr(f"substring(piece, before - lo + 1, lo + {length} - hi)")
    return cut.select(F.xxhash64("key", "lo", "hi", core).alias("key"), "run", "ahead", "behind", "lo", "hi",
                      F.expr(f"substring(piece, before - behind + 1, behind + {length} - ahead)").alias("piece"))


def _cut_up(level: DataFrame, length: int, gram: int, first_stays: bool, most: int) -> list[DataFrame]:
    """`_compared` for keys with more than `most` stretches: halved until they have fewer. At a single
    distance all stretches of a key are one, so that takes at most as many rounds as halvings."""
    found, same = [], ["key", "ahead", "behind", "lo", "hi", "piece"]
    level = level.withColumns({"lo": F.lit(0), "hi": F.lit(length - gram)})
    while True:
        halves = pinned(_halves(level, length), "halves")
        kinds = pinned(halves.groupBy(*same).agg(F.min("run").alias("run"), F.count("*").alias("n")), "kinds")
        alike = halves.join(kinds.filter("n > 1").select(*same, F.col("run").alias("one")), same)
        found.append(pinned(alike.filter("run != one" if first_stays else "true").select(
            "run", F.col("ahead").alias("least"), F.col("behind").alias("largest")), "alike"))
        sizes = pinned(kinds.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "sizes")
        met = kinds.drop("n")
        found.append(pinned(_compared(met.join(sizes.filter(F.col("m") <= most), "key").select(
            "key", "run", "ahead", "behind", "piece"), length, gram, first_stays), "compared"))
        large = sizes.filter(F.col("m") > most)
        if large.isEmpty():
            return found
        level = met.join(large.select("key"), "key")


@lru_cache(maxsize=1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def _packed() -> Column:
    """The payload compressed, for the shuffles that carry whole texts."""
    return F.udf(_pack, "binary", useArrow=False)("payload").alias("packed")


def repeated_spans(documents: DataFrame, length: int, keep: str) -> DataFrame:
    """(doc, h1, h2, spans): the stretches to remove, per document."""
    spark = documents.sparkSession
    first_stays = keep == "first"
    path = scratch_path(spark, "runs")
    _runs_of(documents, length).write.parquet(path)
    everything = spark.read.parquet(path)
    often = pinned(everything.groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    found = pinned(everything.join(often, "anchor"), "repeated")
    remove(spark, path)
    member = F.struct("doc", "low", "h1", "h2", "high")
    classes = pinned(found.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.max("behind").alias("behind"), F.min(member).alias("first"))
        .repartitionByRange("first").sortWithinPartitions("first")
        .withColumn("run", F.monotonically_increasing_id()), "classes")
    # Runs are numbered by position, and a string occurs once at its distance, so a run's number is a position.
    shared = pinned(classes.groupBy("anchor").agg(F.count("*").alias("m")).filter("m > 1"), "shared")

    def stretches(anchors: DataFrame) -> DataFrame:
        columns = ["anchor", "run", "behind", "low", "high"]
        listed = (classes.join(anchors.select("anchor"), "anchor").select("anchor", "run", "behind", "first.*")
                  .groupBy("h1", "h2", "doc").agg(F.collect_list(F.struct(*columns)).alias("listed"))
                  .select("h1", "h2", "doc", *[F.col(f"listed.{c}").alias(f"{c}s") for c in columns]))
        # Rows equal in doc_id and text are one text here; copies of a text under other ids have no runs listed.
        texts = documents.select("h1", "h2", "doc", _packed()).join(
            listed, ["h1", "h2", "doc"]).dropDuplicates(["h1", "h2", "doc"])
        return _stretches(texts, length)

    most = GROUP
    parts = [_compared(stretches(shared.filter(F.col("m") <= most)), length, GRAM, first_stays)]
    large = shared.filter(F.col("m") > most)
    if not large.isEmpty():
        parts += _cut_up(pinned(stretches(large), "stretches"), length, GRAM, first_stays, most)
    compared = pinned(reduce(DataFrame.unionByName, parts).groupBy("run").agg(
        F.min("least").alias("least"), F.max("largest").alias("largest")), "compared")
    marked = pinned(classes.join(compared, "run", "left").filter("n > 1 or least is not null").select(
        "anchor", "digest", "n", "first", (F.col("behind") - F.col("largest")).alias("from"),
        (F.col("behind") - F.col("least")).alias("to")), "marked")
    joined = found.join(marked, ["anchor", "digest"])
    whole = member != F.col("first") if first_stays else F.col("n") > 1
    low = F.when(whole, F.col("low")).otherwise(F.col("low") + F.col("from"))
    high = F.when(whole, F.col("high")).otherwise(F.col("low") + F.col("to"))
    spans = joined.select("doc", "h1", "h2", low.alias("start"), (high + length).alias("end")).filter(
        "start is not null").distinct()
    return pinned(spans.groupBy("doc", "h1", "h2").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal stretches covered by spans."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _rest(packed: bytes, listed: list) -> tuple[int, int, bytes]:
    data, stretches, at, parts = _zstd()[1].decompress(packed), merged(listed), 0, []
    for start, end in stretches:
        parts.append(data[at:start])
        at = end
    return sum(e - s for s, e in stretches), len(stretches), b"".join([*parts, data[at:]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    ship(docs.sparkSession)
    documents = _documents(docs)
    with small_batches(docs.sparkSession):
        spans = repeated_spans(documents, length, keep)
    rest = F.udf(_rest, "n_removed bigint, n_spans bigint, kept binary", useArrow=False)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = documents.select("doc_id", "doc", "h1", "h2", F.octet_length("payload").cast("bigint").alias("n_bytes"),
                              _packed()).join(spans, ["doc", "h1", "h2"], "left")
    return joined.select("doc_id", "n_bytes", rest.asNondeterministic()("packed", F.coalesce("spans", none)).alias("rest")).select(
        "doc_id", "n_bytes", "rest.n_removed", "rest.n_spans", "rest.kept")


def repeats_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, keep="none").withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
