"""SimHash near-duplicates by deletion-variant signatures.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes of its word shingles. Two
fingerprints within `MAX_BITS` = 3 bits, cut into two segments of 32 bits, differ by at most one bit in
one of them. So each segment is indexed under its 32 one-wildcard variants (the segment without one
bit), variants are brought together by equality, and every pair in a bucket is verified on all 64 bits.

Documents with one fingerprint are one row from the start. A bucket yields a spanning forest of its
links, not its pairs: components are the same, and a bucket of m near copies gives at most m - 1 rows.
Buckets are read as a sorted stream of (key, fingerprint): memory is one bucket of 8 bytes a member.

Defined cases: words are runs of other characters than `\\x20\\x09-\\x0D`, ASCII letters are lower-cased;
a text of fewer words than a shingle is one shingle; a null, empty or blank text has fingerprint 0, linked
like any other; null doc_ids take part and are never the smallest id unless a component has no other;
rows with one doc_id are separate rows. An empty table gives an empty result. Only doc_id and text are
read; `drop_near_copies` keeps all other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import fresh, text_or_empty
from riverdeck.llm.components import components
from riverdeck.llm.shipping import ship
from riverdeck.session import pinned

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENT = 32
BLOCK = 65_536
#: From this many members on, a bucket is first cut by the bytes of its other segment.
LARGE_BUCKET = 4096


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    columns = [islice(words, k, None) for k in range(min(shingle, len(words)))]
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*columns)), repeat(SEED))
    ones, total = np.zeros(64, np.int64), 0
    while (block := np.fromiter(islice(hashes, BLOCK), np.uint64)).size:
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += block.size
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(shingle: int = SHINGLE):
    """A Column function: fingerprint of a text."""
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "", shingle) for t in texts], dtype="int64")

    return of


def variants(fp: Column) -> Column:
    """The 64 index keys of a fingerprint: segment, deleted bit, the 31 bits left."""
    def key(i: Column) -> Column:
        bit = i % SEGMENT
        part = F.when(i < SEGMENT, F.shiftrightunsigned(fp, SEGMENT)).otherwise(fp.bitwiseAND(2 ** SEGMENT - 1))
        low = part.bitwiseAND(F.expr("cast(1 as bigint)") * F.pow(F.lit(2), bit).cast("bigint") - 1)
        high = F.floor(part / F.pow(F.lit(2), bit + 1)).cast("bigint") * F.pow(F.lit(2), bit).cast("bigint")
        return i.cast("bigint") * 2 ** 31 + high + low

    return F.transform(F.sequence(F.lit(0), F.lit(2 * SEGMENT - 1)), key)


def forest(members: np.ndarray, max_bits: int = MAX_BITS) -> tuple[list, list]:
    """A spanning forest of the links among distinct fingerprints (unsigned)."""
    left, right, rest = [], [], members
    while rest.size > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and rest.size:
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                left.extend([at] * found.size)
                right.extend(found)
                queue.extend(found)
    return left, right


def bucket_links(members: np.ndarray, max_bits: int = MAX_BITS) -> tuple[list, list]:
    """Links that connect what is linked within a bucket. A large bucket is cut again: at most 3 bits
    differ, so of the eight bytes those that two members share suffice to find each link, and among
    any four bytes there is one."""
    if members.size < LARGE_BUCKET:
        return forest(members, max_bits)
    halves = members >> np.uint64(SEGMENT), members & np.uint64(2 ** SEGMENT - 1)
    other = max(halves, key=lambda h: np.unique(h).size)  # the segment in which they may differ freely
    left, right = [], []
    for byte in range(4):
        piece = (other >> np.uint64(8 * byte)) & np.uint64(255)
        for value in np.unique(piece):
            a, b = forest(members[piece == value], max_bits)
            left += a
            right += b
    return left, right


def sorted_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, fp), sorted by key -> links (a, b) of each bucket, a bucket at a time."""
    def links(keys: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], keys.size]
        pair = starts[ends - starts == 2]
        near = pair[np.bitwise_count(fps[pair] ^ fps[pair + 1]) <= MAX_BITS]
        a, b = [fps[near]], [fps[near + 1]]
        for s, e in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
            x, y = bucket_links(fps[s:e])
            a.append(np.array(x, np.uint64))
            b.append(np.array(y, np.uint64))
        return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)}
                            ).drop_duplicates()

    held, key = [], None  # the bucket that may go on in the next batch
    for batch in batches:
        keys, fps = batch["key"].to_numpy(), batch["fp"].to_numpy().view(np.uint64)
        if not keys.size:
            continue
        if keys[0] == key == keys[-1]:
            held.append(fps)
            continue
        if held:
            own = np.concatenate(held)
            keys, fps = np.r_[np.full(own.size, key), keys], np.r_[own, fps]
        last = np.searchsorted(keys, keys[-1])
        if last:
            yield links(keys[:last], fps[:last])
        held, key = [fps[last:]], keys[-1]
    if held:
        own = np.concatenate(held)
        yield links(np.full(own.size, key), own)


def classes(fps: DataFrame) -> DataFrame:
    """(fp) of all rows -> (fp, root) of each distinct fingerprint; root names its component."""
    ship(fps.sparkSession)
    distinct = pinned(fps.select("fp").distinct(), "fingerprints")
    indexed = distinct.select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    links = (indexed.repartition("key").sortWithinPartitions("key")
             .mapInPandas(sorted_links, "a bigint, b bigint"))
    roots = pinned(components(links), "roots")
    return pinned(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root")), "classes")


def near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, fp, fingerprint (hex), component_id."""
    ship(docs.sparkSession)
    rows = pinned(docs.select("doc_id", fingerprints(shingle)(text_or_empty()).alias("fp")), "rows")
    roots = classes(rows)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")).join(roots, "fp")
    labels = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = pinned(roots.join(labels, "root").select("fp", "component_id"), "labels")
    return rows.join(named, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_copy_report(docs: DataFrame) -> DataFrame:
    return near_copies(docs).select("doc_id", "fingerprint", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (of equal ones, the first written)."""
    ship(docs.sparkSession)
    row, fp = fresh(docs, "row_of_copy"), fresh(docs, "fingerprint_of_copy")
    rows = pinned(docs.withColumn(fp, fingerprints(shingle)(text_or_empty()))
                  .withColumn(row, F.monotonically_increasing_id()), "rows")
    small = rows.select(F.col(fp).alias("fp"), F.col(row).alias("at"), "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "at"))
    per_fp = small.groupBy("fp").agg(first.alias("first"))  # copies meet here, before any join
    kept = (per_fp.join(classes(small), "fp").groupBy("root").agg(F.min("first").alias("first"))
            .select(F.col("first.at").alias(row)))
    # The kept rows grow with the corpus: a sorted join at every size, by row numbers, which are spread evenly.
    return rows.join(pinned(kept, "kept").hint("merge"), row, "left_semi").select(*docs.columns)
