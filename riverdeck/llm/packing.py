"""Best-fit-decreasing packing of tokenized documents into sequences of at most `WINDOW` tokens.

A document longer than a window is first cut into full windows, which are sequences of their own, and a
rest. Rests, longest first, go into the tightest open window that holds them: a segment tree over the
remaining capacities 0..WINDOW finds it in log(WINDOW) steps; if none does, a window is opened.

Rests are dealt by a hash of their row into shards of about `SHARD` pieces, each packed by one task, so
work and memory per task stay the same at any size; the windows left unfilled at a shard's end are a few
in thousands. Pieces and places travel without their tokens (`with_ids` carries them along).

A document's tokens are the vocabulary's ids without special ones, then `END`. Texts of `PLAIN` characters
are lower-cased and cut at blanks, and ids of a word are found once and remembered, within `REMEMBERED`
words per worker; any other text is the library's as a whole. Tasks hand over pieces in batches of about
`BATCH_BYTES` of ids, whatever the documents' number and length.

Defined cases: a null or empty text is the single token `END`; repeated rows are packed each; null
doc_ids are kept; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import json
import math
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import text_or_empty
from riverdeck.llm.shipping import ship
from riverdeck.llm.token_counts import byte_letters
from riverdeck.llm.vocabulary import located
from riverdeck.session import pinned

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END = 1
SHARD = 16_384
REMEMBERED = 300_000
BATCH_BYTES = 4 << 20

#: A text with any other character goes to the library whole: Unicode tables differ between versions. The tests
#: hold each of these characters against the library.
PLAIN = regex.compile("[\x00-\u012f]*")

#: Fixed value: how this vocabulary cuts a normalized text.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


class WordIds:
    """Ids of a text, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.specials = [t["content"] for t in json.load(f)["added_tokens"]]
        self.letters = byte_letters()
        self.pre_token = regex.compile(PRE_TOKEN)
        self.separators = regex.compile("[\x1c-\x1f]")  # blanks to str.split only
        self.known = _Remembered(self._chunk_ids)

    def _word_ids(self, word: str) -> bytes:
        tokens = self.tokenizer.model.tokenize("".join([self.letters[b] for b in word.encode()]))
        return array("I", [t.id for t in tokens]).tobytes()

    def _chunk_ids(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._word_ids(chunk)
        if chunk[-1] in ".," and chunk[:-1].isalpha():  # the usual end of a word, without a search
            return self.known[chunk[:-1]] + self.known[chunk[-1]]
        return b"".join([self.known[w] if w != chunk else self._word_ids(w) for w in self.pre_token.findall(chunk)])

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.specials) or not (text.isascii() or PLAIN.fullmatch(text)):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        text = text.lower()
        if self.separators.search(text):
            return b"".join(map(self.known.__getitem__, self.pre_token.findall(text)))
        return b"".join(map(self.known.__getitem__, text.split()))


class _Remembered(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(ids: bytes, window: int = WINDOW) -> list[tuple[int, bytes, int]]:
    """(start, ids, tokens of the document) of each full window and of the rest."""
    return [(start, ids[4 * start:4 * (start + window)], len(ids) // 4) for start in range(0, len(ids) // 4, window)]


def _batch(doc_ids: pa.Array, rows: list[int], found: list[tuple[int, bytes, int]], with_ids: bool) -> pa.RecordBatch:
    """Pieces as Arrow columns; all ids lie in one buffer."""
    starts, own, tokens = zip(*found)
    ends = np.cumsum([0, *[len(x) // 4 for x in own]])
    columns = {"doc_id": doc_ids.take(pa.array(rows, pa.int32())), "start": pa.array(starts, pa.int64()),
               "length": pa.array(np.diff(ends), pa.int64()),
               "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64())}
    if with_ids:
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(own), "<i4")))
    return pa.RecordBatch.from_pydict(columns | {"doc_tokens": pa.array(tokens, pa.int64())})


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, with_ids: bool = False, window: int = WINDOW) -> DataFrame:
    """(doc_id, text) -> doc_id, start, length, ids_crc32, [ids,] doc_tokens per piece."""
    ship(docs.sparkSession)
    texts = docs.select("doc_id", text_or_empty().alias("text"))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = word_ids(located(vocabulary)).ids, array("I", [END]).tobytes()
        for batch in batches:
            rows, found, held = [], [], 0
            for row, text in enumerate(batch.column("text")):
                own = cut(ids(text.as_py()) + end, window)
                rows += [row] * len(own)
                found += own
                held += 64 + sum(len(x) for _, x, _ in own)
                if held >= BATCH_BYTES:
                    yield _batch(batch.column("doc_id"), rows, found, with_ids)
                    rows, found, held = [], [], 0
            if found:
                yield _batch(batch.column("doc_id"), rows, found, with_ids)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(cut_up, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, "
                                    + "ids array<int>, " * with_ids + "doc_tokens bigint")


class Capacities:
    """A segment tree over remaining capacities: how many open windows have each."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = self.leaves + capacity
        while at:
            self.count[at] += n
            at >>= 1

    def tightest(self, length: int) -> int:
        """The smallest capacity of at least `length` that an open window has; -1 if none."""
        count, at = self.count, self.leaves + length
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):  # up, until something lies to the right
                at >>= 1
            if at <= 1:
                return -1
            at += 1
            while at < self.leaves:
                at *= 2
                if not count[at]:
                    at += 1
        return at - self.leaves


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(window number, offset) for lengths that come in descending order."""
    tree, open_at, out, opened = Capacities(window), [[] for _ in range(window + 1)], [], 0
    for length in lengths:
        capacity = tree.tightest(length)
        if capacity < 0:
            number, capacity = opened, window
            opened += 1
        else:
            number = open_at[capacity].pop()
            tree.add(capacity, -1)
        out.append((number, window - capacity))
        if capacity > length:
            open_at[capacity - length].append(number)
            tree.add(capacity - length, 1)
    return out


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, with_ids: bool = False, window: int = WINDOW) -> DataFrame:
    """Pieces with their sequence_id and offset there."""
    cut_docs = pinned(pieces(docs, vocabulary, with_ids, window).withColumn("at", F.monotonically_increasing_id()),
                      "pieces")
    rests = cut_docs.filter(F.col("length") < window)
    shards = max(1, math.ceil(rests.count() / SHARD))

    def place(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "at"], ascending=[False, True])
        placed = best_fit_decreasing(shard["length"].tolist(), window)
        return pd.DataFrame({"at": shard["at"], "sequence_id": [(int(shard["shard"].iloc[0]) << 32) + n for n, _ in placed],
                             "offset": [offset for _, offset in placed]})

    places = (rests.select("at", "length", F.pmod(F.xxhash64("at"), F.lit(shards)).alias("shard"))
              .groupBy("shard").applyInPandas(place, "at bigint, sequence_id bigint, offset bigint"))
    alone = cut_docs.filter(F.col("length") == window).select(
        "at", (F.col("at") + F.lit(2 ** 62)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return cut_docs.join(pinned(places.unionByName(alone), "places"), "at").drop("at")


def packing_report(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
