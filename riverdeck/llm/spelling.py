"""Spelling variants: words of a corpus that one inserted, deleted or replaced code point makes equal.

All words go into two tries, one read forwards and one read backwards, whose nodes are numbered. A word cut
at a place is then a pair of integers, (node of the prefix, node of the suffix), and nothing else spells
that pair. `whole` pairs cut a word between two code points; `skip` pairs leave one code point out. Words
that share a skip pair differ by one replaced code point; a skip pair that is another word's whole pair is
a deletion, and an insertion seen from the other side. No distance is computed, and no candidate is wrong.

Numbering. The words lie in range slices of their (reversed) order; a slice is a task. In sorted order a
prefix is new, or shared with the word before, so a stack gives each node the number slice << 44 | place. A
prefix that crosses from a slice into the next belongs to the path of some slice's last word, where depth
names it: slice << 44 | 1 << 43 | depth, with the first such slice. Tasks need only the first and last word
of the slices before for that.

Links are never written out. Members of a pair differ in the skipped code point alone, so there are at
most as many as letters, and the count of near words and the best one are figures of the pair's members.
Deleting any letter of a run of equal ones gives the same word; only the run's first counts.

Every step is linear in the words' letters, however long a word is, with one row per letter and pair.
`form` leads to a word at least `FACTOR` times as frequent, so chains are shorter than the logarithm of the
largest count, and doubling the steps follows them to the end in a known number of joins.

Defined cases: a null text has no words, a null doc_id is written as the empty string, repeated rows count
each; among equally frequent near words the smallest in code-point order is the form; no documents, or
none with words, give an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import text_or_empty
from riverdeck.llm.shipping import ship
from riverdeck.session import pinned, slice_count

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, FACTOR, TYPO_EVERY = 6, 5, 5, 199
#: Words of a slice, about.
SLICE_WORDS = 200_000
#: Bits for a node's place in its slice, and the bit that marks nodes shared by slices.
PLACE_BITS = 44
SHARED = 1 << (PLACE_BITS - 1)


def word_occurrences(docs: DataFrame, typo_every: int | None = None) -> DataFrame:
    """(word): a row per occurrence of at least `LEAST_LENGTH` letters, A-Z in lower case. With `typo_every`,
    one letter is left out of an occurrence where that number divides the crc32 of doc_id and word."""
    runs = F.regexp_extract_all(F.translate(text_or_empty(), UPPER, LOWER),
                                F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    if typo_every is None:
        return found.select(F.col("run").alias("word"))
    run, h = F.col("run"), F.col("h")
    at = h % F.length(run)
    mistyped = F.concat(F.substring(run, F.lit(1), at.cast("int")), F.substring(run, (at + 2).cast("int"), F.length(run)))
    return found.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))).select(
        F.when(h % typo_every == 0, mistyped).otherwise(run).alias("word")).filter(F.length("word") >= LEAST_LENGTH)


def frequent_words(docs: DataFrame, least_count: int = LEAST_COUNT, typo_every: int | None = None) -> DataFrame:
    """(word, n): the words that occur at least `least_count` times."""
    counted = word_occurrences(docs, typo_every).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def in_slices(words: DataFrame, rows: int) -> DataFrame:
    """The rows sorted by `word` into range slices, with `id` in that order (slice << 33 | place), written."""
    slices = max(slice_count(words.sparkSession), math.ceil(rows / SLICE_WORDS))
    return pinned(words.repartitionByRange(slices, "word").sortWithinPartitions("word")
                  .withColumn("id", F.monotonically_increasing_id()), "words")


def slice_of(id_: Column) -> Column:
    return F.shiftright(id_, 33)


def shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def trie_nodes(words: Iterable[str], here: int, bounds: list[tuple[int, str, str]]) -> Iterable[list[int]]:
    """For each of the sorted words of slice `here`, the nodes of its prefixes of length 0, 1, ...

    `bounds` are (slice, first word, last word) of all slices with words, in order.
    """
    order = [b[0] for b in bounds].index(here)
    last = bounds[order][2]
    goes_on = shared_prefix(last, bounds[order + 1][1]) if order + 1 < len(bounds) else -1
    path: list[int] = []
    before = ""
    if order:  # the path of the word before this slice, named by the first slice whose last word shares it
        before = bounds[order - 1][2]
        path = [0] * (len(before) + 1)
        named = 0
        for owner, _, other in bounds[:order]:
            shared = shared_prefix(other, before)
            for depth in range(named, shared + 1):
                path[depth] = owner << PLACE_BITS | SHARED | depth
            named = max(named, shared + 1)
    place = here << PLACE_BITS
    for word in words:
        known = shared_prefix(before, word) + 1 if path else 0
        ends_shared = min(goes_on, shared_prefix(word, last)) + 1
        path = path[:known] + [
            here << PLACE_BITS | SHARED | depth if depth < ends_shared else place + depth
            for depth in range(known, len(word) + 1)]
        yield path
        place += len(word) + 1
        before = word


def run_starts(word: str) -> list[bool]:
    """Whether each letter differs from the one before."""
    return [k == 0 or word[k - 1] != c for k, c in enumerate(word)]


def numbered(slices: DataFrame) -> DataFrame:
    """(word, id) in slices -> id, nodes (of the prefixes of length 0, 1, ...), starts (see `run_starts`)."""
    with_slice = slices.select("word", "id", slice_of(F.col("id")).alias("slice"))
    # One row per slice, and a slice holds a bounded number of words.
    bounds = sorted(tuple(r) for r in with_slice.groupBy("slice").agg(F.min("word"), F.max("word")).collect())

    def number(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("id")
        words = own["word"].tolist()
        nodes = [np.array(path, np.int64) for path in trie_nodes(words, int(own["slice"].iloc[0]), bounds)]
        return pd.DataFrame({"id": own["id"], "nodes": nodes, "starts": [run_starts(w) for w in words]})

    return with_slice.groupBy("slice").applyInPandas(number, "id bigint, nodes array<bigint>, starts array<boolean>")


def pairs(slices: DataFrame, rows: int) -> DataFrame:
    """(word, n, id) in slices -> id, n, p, s, skip, start: each word's pairs of trie nodes."""
    ship(slices.sparkSession)
    backwards = in_slices(slices.select(F.reverse("word").alias("word"), F.col("id").alias("word_id")), rows)
    suffixes = numbered(backwards).join(backwards.select("id", "word_id"), "id").select(
        F.col("word_id").alias("id"), F.col("nodes").alias("suffixes"))
    both = slices.select("id", "n").join(numbered(slices), "id").join(suffixes, "id")
    length = F.size("nodes") - 1

    def pair(at: Column, skip: bool) -> Column:
        return F.struct(F.get("nodes", at).alias("p"), F.get("suffixes", length - at - (1 if skip else 0)).alias("s"),
                        F.lit(skip).alias("skip"), (F.get("starts", at) if skip else F.lit(False)).alias("start"))

    cuts = F.concat(F.transform(F.sequence(F.lit(0), length - 1), lambda at: pair(at, True)),
                    F.transform(F.sequence(F.lit(0), length), lambda at: pair(at, False)))
    return both.select("id", "n", F.inline(cuts))


def near_words(found: DataFrame) -> DataFrame:
    """Pairs -> id, n_near, best (struct n, order): words with a near word, how many there are and which is
    the most frequent; `order` is minus its id, so that ties go to the first in order."""
    met = found.groupBy("p", "s").agg(F.collect_list(F.struct(
        "n", (-F.col("id")).alias("order"), "skip", "start")).alias("members")).filter(F.size("members") > 1)

    def rank(m: Column) -> Column:
        return F.struct(m["n"].alias("n"), m["order"].alias("order"))

    ranked = met.withColumn("first", F.array_max(F.transform("members", rank)))
    ranked = ranked.withColumn("second", F.array_max(F.filter(F.transform("members", rank), lambda r: r != F.col("first"))))
    ranked = ranked.withColumn("skips", F.size(F.filter("members", lambda m: m["skip"]))).withColumn(
        "starts", F.size(F.filter("members", lambda m: m["start"])))
    member, has_whole = F.col("m"), F.size("members") > F.col("skips")
    near = F.when(member["skip"], F.col("skips") - 1 + (has_whole & member["start"]).cast("int")).otherwise(F.col("starts"))
    return (ranked.select("*", F.explode("members").alias("m"))
            .select((-member["order"]).alias("id"), near.alias("near"),
                    F.when(rank(member) == F.col("first"), F.col("second")).otherwise(F.col("first")).alias("best"))
            .groupBy("id").agg(F.sum("near").cast("bigint").alias("n_near"), F.max("best").alias("best")))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(id, form) -> id, root: forms followed to the last. `most` is the largest count of any word: each step
    multiplies the count by `FACTOR` at least, which bounds the chains; steps double each round."""
    longest = max(1, math.ceil(math.log(max(most, 2), FACTOR)))
    led = forms.select("id", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        further = led.select(F.col("id").alias("root"), F.col("root").alias("further"))
        led = pinned(led.join(further, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "roots")
    return led


def variants(words: DataFrame) -> DataFrame:
    """(word, n), each word once -> word, n, form, root, n_near, form_n."""
    words = pinned(words, "frequent")
    rows, most = words.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    slices = in_slices(words, rows)
    near = pinned(near_words(pairs(slices, rows)).join(slices.select("id", "n"), "id").select(
        "id", "n_near", F.when(F.col("best.n") >= FACTOR * F.col("n"), F.struct(
            (-F.col("best.order")).alias("id"), F.col("best.n").alias("n"))).alias("form")), "near")
    forms = pinned(near.filter("form is not null").select("id", F.col("form.id").alias("form"), F.col("form.n").alias("form_n")),
                   "forms")
    named = slices.select(F.col("id").alias("other"), F.col("word").alias("name"))
    led = roots(forms, most)
    spelled = (forms.join(led, "id")
               .join(named, F.col("form") == F.col("other")).select("id", F.col("name").alias("form"), "form_n", "root")
               .join(named, F.col("root") == F.col("other")).select("id", "form", "form_n", F.col("name").alias("root")))
    return (slices.join(near.select("id", "n_near"), "id", "left").join(spelled, "id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"))


def spelling_report(docs: DataFrame) -> DataFrame:
    """The words of the documents, one letter missing in some occurrences, with their forms and roots."""
    return variants(frequent_words(docs, typo_every=TYPO_EVERY))
