"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at special strings (one token each) and then into pre-tokens. A pre-token starts as a
linked list of its UTF-8 bytes; a heap holds the rank of each adjacent pair that can merge, and the
lowest rank (the leftmost, if equal) is popped until none is left. The count is bytes minus merges; no
identifiers are emitted. Counts of short pre-tokens are remembered per worker, within `REMEMBERED`.

The work is one pass over the rows with no shuffle; a document of n bytes takes O(n log n) time.

Defined cases: a null text is empty; an empty text has 0 bytes and 0 tokens; every input row gives one
row, repeated doc_ids included; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import text_or_empty
from riverdeck.llm.shipping import ship
from riverdeck.llm.vocabulary import located

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
REMEMBERED = 200_000
LONG_TOKEN = 64
LONG_TEXT = 1_000_000

#: Fixed value: how byte-level vocabularies cut a text before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such vocabularies: itself where printable, else the
    next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class PairMerger:
    """Counts the symbols left when all merges of a vocabulary are done."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.byte_ids = [ids[letter] for letter in byte_letters()]
        self.merged = {}  # (left id, right id) -> (rank, merged id)
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merged.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.pre_token = regex.compile(PRE_TOKEN)
        self.known = _Known(self.symbols)

    def symbols(self, pre_token: str) -> int:
        symbol = [self.byte_ids[b] for b in pre_token.encode()]
        n, merged = len(symbol), self.merged
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []
        for at in range(n - 1):
            found = merged.get((symbol[at], symbol[at + 1]))
            if found:
                heap.append((found[0], at, found[1], symbol[at], symbol[at + 1]))
        heapify(heap)
        left = n
        while heap:
            _, at, made, first, second = heappop(heap)
            right = after[at]
            if right < 0 or symbol[at] != first or symbol[right] != second:
                continue  # one of the two has been merged since
            symbol[at], symbol[right] = made, -1
            beyond = after[at] = after[right]
            after[right] = -1
            left -= 1
            if beyond >= 0:
                before[beyond] = at
                found = merged.get((made, symbol[beyond]))
                if found:
                    heappush(heap, (found[0], at, found[1], made, symbol[beyond]))
            ahead = before[at]
            if ahead >= 0:
                found = merged.get((symbol[ahead], made))
                if found:
                    heappush(heap, (found[0], ahead, found[1], symbol[ahead], made))
        return left

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        for part in parts:
            if len(part) < LONG_TEXT:
                total += sum(map(self.known.__getitem__, self.pre_token.findall(part)))
            else:  # without a list of all its pre-tokens
                total += sum(self.known[m.group()] for m in self.pre_token.finditer(part))
        return total


class _Known(dict):
    """Counts by pre-token; emptied when full."""

    def __init__(self, symbols):
        super().__init__()
        self.symbols = symbols

    def __missing__(self, pre_token: str) -> int:
        count = self.symbols(pre_token)
        if len(pre_token) <= LONG_TOKEN:
            if len(self) >= REMEMBERED:
                self.clear()
            self[pre_token] = count
        return count


@lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    return PairMerger(path)


def token_count(vocabulary: str = VOCABULARY):
    """A Column function: tokens of a text (0 for null)."""
    @F.pandas_udf("bigint")
    def counted(texts: pd.Series) -> pd.Series:
        count = merger(located(vocabulary)).count
        return pd.Series([count(t) if t else 0 for t in texts], dtype="int64")

    return counted


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_tokens, over_limit."""
    ship(docs.sparkSession)
    text = text_or_empty()
    return docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"),
                       token_count(vocabulary)(text).alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > limit)
