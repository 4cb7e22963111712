"""Filter interaction audit: what each of five filters removes, in every order they could be applied.

Each document is reduced to five verdicts. Documents of one part with the same five verdicts count
together, so a part is a contingency tensor of 2 x 2 x 2 x 2 x 2 counts (axis k: filter k passed, failed),
one for all documents, one for good ones and one for toxic ones. A figure of a step is a contraction of
that tensor: along each axis a selector vector picks "passed" (1, 0), "failed" (0, 1) or "either" (1, 1).
The filter at step k of an order removes those that passed the filters before it and failed it; what was
removed earlier, or what only it rejects, are other selectors over the same counts.

The documents are read once. A text travels as its digest (SHA-256 and length), never itself. The smallest
doc_id of each text is an aggregate that is combined before the shuffle; it meets the documents on digest
and doc_id together, so a group of copies however large spreads over all tasks. What reaches the
contraction is at most 32 rows a part, and each part is contracted on its own.

Defined cases: a null text is empty (0 words: fails A only, and E if a smaller doc_id has an empty text
too); a null lang is the part ''; rows that repeat a doc_id are documents each, and as only a smaller
doc_id counts they do not make each other fail E; a null doc_id is smaller than none, larger than none
and has no labels; of repeated labels any good (toxic) one counts; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.llm.columns import WORD, let, text_or_empty
from riverdeck.llm.shipping import ship
from riverdeck.session import pinned

FILTERS = "ABCDE"
PASSED, FAILED, EITHER = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)


def text_verdicts(text: Column) -> Column:
    """struct(A, B, C, D) of a non-null text; true where the filter rejects it."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return let(words, lambda w: F.struct(
        (F.size(w) < 200).alias("A"),
        (100 * F.size(F.array_distinct(w)) < 50 * F.size(w)).alias("B"),
        (100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text)).alias("C"),
        text.rlike("[#$%&*|]").alias("D")))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A..E, docs, good, toxic): documents counted by their part and five verdicts."""
    text, part = text_or_empty(), F.coalesce("lang", F.lit(""))
    judged = docs.select("doc_id", part.alias("part"), F.sha2(text, 256).alias("digest"),
                         F.octet_length(text).alias("bytes"), text_verdicts(text).alias("v"))
    rows = pinned(judged.select("doc_id", "part", "digest", "bytes", "v.*"), "verdicts")
    first = (rows.filter(F.col("doc_id").isNotNull()).groupBy("digest", "bytes")
             .agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True)))
    marked = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
              .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                   F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    # Repeated rows count together before the joins, so no key of a join repeats on this side but null.
    counted = rows.groupBy("doc_id", "part", "digest", "bytes", *"ABCD").agg(F.count("*").alias("n"))
    known = counted.filter(F.col("doc_id").isNotNull()).join(first, ["doc_id", "digest", "bytes"], "left").join(
        marked, "doc_id", "left").withColumn("E", F.col("is_first").isNull())
    unknown = counted.filter(F.col("doc_id").isNull()).withColumns({
        "E": F.lit(False), "good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    columns = ["part", *FILTERS, "n", "good", "toxic"]
    n = F.col("n")
    return known.select(columns).unionByName(unknown.select(columns)).groupBy("part", *FILTERS).agg(
        F.sum("n").alias("docs"), F.sum(F.coalesce(n * F.col("good"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(n * F.col("toxic"), F.lit(0))).alias("toxic"))


def contracted(tensor: np.ndarray, selectors: list[np.ndarray]) -> int:
    """The tensor's counts that the selectors, one per axis, leave."""
    return int(np.einsum("abcde,a,b,c,d,e->", tensor, *selectors))


def tensors(counts: pd.DataFrame) -> dict[str, np.ndarray]:
    """Contingency tensors (2, 2, 2, 2, 2) of documents, good and toxic ones; counts not given are 0."""
    cell = sum(counts[f].astype(np.int64).to_numpy() << (len(FILTERS) - 1 - k) for k, f in enumerate(FILTERS))
    out = {}
    for name in ("docs", "good", "toxic"):
        flat = np.zeros(2 ** len(FILTERS), np.int64)
        np.add.at(flat, cell, counts[name].astype(np.int64).to_numpy())
        out[name] = flat.reshape((2,) * len(FILTERS))
    return out


def steps(counts: pd.DataFrame) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders."""
    own = tensors(counts)

    def chosen(tensor: str, before: str, axis: str | None, there: np.ndarray, others: np.ndarray = EITHER) -> int:
        """Count with the filters `before` passed, `axis` as `there`, all others as `others`."""
        return contracted(own[tensor], [there if f == axis else PASSED if f in before else others for f in FILTERS])

    rows = []
    for order in permutations(FILTERS):
        for step, f in enumerate(order, 1):
            before = "".join(order[:step - 1])
            removed = chosen("docs", before, f, FAILED)
            rows.append(("".join(order), step, chosen("docs", before, f, PASSED), removed,
                         chosen("docs", "", f, FAILED) - removed, chosen("docs", "", f, FAILED, PASSED),
                         chosen("good", before, f, FAILED), chosen("toxic", before, f, FAILED)))
    total = dict.fromkeys(FILTERS, 0)
    for order, step, _, removed, *_ in rows:
        total[order[step - 1]] += removed
    return [(*row, total[row[0][row[1] - 1]]) for row in rows]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    ship(docs.sparkSession)

    def of_part(counts: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(steps(counts), columns=["filter_order", "step", *COUNTS])
        out.insert(0, "part", counts["part"].iloc[0])
        return out

    return verdicts(docs, labels).groupBy("part").applyInPandas(of_part, RESULT)


_LETTERS = ", ".join(f"('{f}')" for f in FILTERS)
AUDIT_SQL = f"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
  from documents),
marked as (
  select doc_id, max(cast(quality = 1 as int)) as good, max(cast(toxic = 1 as int)) as toxic from labels group by doc_id),
judged as (
  select t.part, coalesce(m.good, 0) as good, coalesce(m.toxic, 0) as toxic,
         len(words) < 200 as fails_a,
         100 * len(list_distinct(words)) < 50 * len(words) as fails_b,
         100 * len(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * len(text) as fails_c,
         regexp_matches(text, '[#$%&*|]') as fails_d,
         coalesce(t.doc_id > min(t.doc_id) over (partition by text), false) as fails_e
  from texts t left join marked m on m.doc_id = t.doc_id),
counted as (
  select part, fails_a, fails_b, fails_c, fails_d, fails_e,
         concat(case when fails_a then 'A' else '' end, case when fails_b then 'B' else '' end,
                case when fails_c then 'C' else '' end, case when fails_d then 'D' else '' end,
                case when fails_e then 'E' else '' end) as failed,
         count(*) as docs, sum(good) as good, sum(toxic) as toxic
  from judged group by all),
letters(f) as (values {_LETTERS}),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where b.f <> a.f and c.f not in (a.f, b.f) and d.f not in (a.f, b.f, c.f) and e.f not in (a.f, b.f, c.f, d.f)),
placed as (
  select filter_order, step, filter_order[step] as f, filter_order[:step - 1] as earlier
  from orders, (select unnest(range(1, 6)) as step)),
met as (
  select c.part, p.filter_order, p.step, p.f, c.docs, c.good, c.toxic,
         contains(c.failed, p.f) as fails, c.failed = p.f as fails_only,
         regexp_matches(c.failed, '[' || p.earlier || '-]') as gone
  from placed p, counted c),
figures as (
  select part, filter_order, step, f,
         coalesce(sum(docs) filter (not gone and not fails), 0) as kept,
         coalesce(sum(docs) filter (not gone and fails), 0) as removed,
         coalesce(sum(docs) filter (gone and fails), 0) as redundant,
         coalesce(sum(docs) filter (fails_only), 0) as unique_fails,
         coalesce(sum(good) filter (not gone and fails), 0) as good_lost,
         coalesce(sum(toxic) filter (not gone and fails), 0) as toxic_lost
  from met group by part, filter_order, step, f)
select part, filter_order, cast(step as int) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, f) as bigint) as shapley
from figures
"""
