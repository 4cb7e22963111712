"""Mixing sources to target weights.

Words are summed per source, a target follows from the source's weight, and target over size is the
source's repetition rate: each document is emitted floor(rate) times, plus one copy when a number in
[0, 1) hashed from its doc_id and the seed lies below the fraction. The choice depends on nothing
else, so reruns, other partitionings and lost executors give the same mix.

Sources in order of their code points, null last, weigh 5, 2, 1, repeating. All targets together are
all words. A target stops at `MOST_REPEATS` times its source's size; the excess goes to the others by
weight until none is above.

Defined cases: a null text is empty (size 0); a null source is a source of its own; a null doc_id
hashes as the empty string; rows with one doc_id share their draw; a source without words has target
0 and emits nothing; an empty table gives an empty result. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverdeck.llm.columns import fresh, word_count
from riverdeck.session import pinned

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, size) per document -> one row per source: source, source_size, target, rate.

    Water filling: with sources in order of cap / weight, the level is the first at which sharing what
    the capped ones leave keeps the source at hand under its cap. The windows see one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place - 1) % len(WEIGHTS) + 1)
    weighed = per_source.withColumn("weight", weight).withColumn(
        "cap", (MOST_REPEATS * F.col("source_size")).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    filled = (
        weighed.withColumn("rank", F.row_number().over(by_ratio))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)),
                                         F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(everything) - F.col("before")) / F.col("left"))
        .withColumn("holds", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("first", F.min(F.when(F.col("holds"), F.struct("rank", "level"))).over(everything)))
    target = F.when(F.col("rank") < F.col("first.rank"), F.col("cap")).otherwise(
        F.col("first.level") * F.col("weight"))
    return filled.withColumn("target", target).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 13 hex digits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + (draw(doc_id, seed) < rate - whole).cast("bigint")).cast("bigint")


def repetition(docs: DataFrame, seed: str = SEED) -> tuple[DataFrame, dict[str, str]]:
    """The documents with size, source_size, target and copies; the names those columns got."""
    names = {n: fresh(docs, n) for n in ("size", "source_size", "target", "copies")}
    size = word_count(F.col("text"))
    # One row per source, written: its size is known before the join, so Spark broadcasts it only
    # under its own threshold, and else splits the hot source of a shuffled join.
    targets = pinned(source_targets(docs.select("source", size.alias("size"))), "targets").select(
        *[F.col(c).alias(f"mix_{c}") for c in ("source", "source_size", "target", "rate")])
    joined = docs.alias("d").join(targets, F.col("d.source").eqNullSafe(F.col("mix_source")))
    return joined.select(
        "d.*", word_count(F.col("d.text")).alias(names["size"]),
        F.col("mix_source_size").alias(names["source_size"]), F.col("mix_target").alias(names["target"]),
        copies(F.col("mix_rate"), F.col("d.doc_id"), seed).alias(names["copies"])), names


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed documents, with the input's columns; a document comes as often as it is taken."""
    repeated, names = repetition(docs, seed)
    each = fresh(repeated, "each")
    return (repeated.withColumn(each, F.explode(F.sequence(F.lit(0), F.col(names["copies"]).cast("int"))))
            .filter(F.col(each) > 0).select(*docs.columns))


def mixing_report(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (its words in the mix, repeats counted)."""
    repeated, _ = repetition(docs.select("doc_id", "source", "text"), seed)
    return repeated.select("doc_id", "size", "source_size", "target",
                           (F.col("size") * F.col("copies")).alias("taken"))


MIXING_SQL = f"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size from documents),
per_source as (
  select source, cast(sum(size) as bigint) as source_size,
         [5.0::double, 2.0::double, 1.0::double][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from sized group by source),
ordered as (
  select *, cast({MOST_REPEATS} * source_size as double) as cap,
         row_number() over (order by {MOST_REPEATS} * source_size / weight, source nulls last) as rank
  from per_source),
leveled as (
  select o.*, (sum(source_size) over () - coalesce(sum(cap) over (order by rank rows between unbounded preceding
                 and 1 preceding), 0)) / sum(weight) over (order by rank rows between current row and
                 unbounded following) as level
  from ordered o),
first_open as (
  select level, rank from leveled where level * weight <= cap order by rank limit 1),
targets as (
  select l.source, l.source_size,
         case when l.rank < f.rank then l.cap else f.level * l.weight end as target
  from leveled l, first_open f),
rated as (
  select s.doc_id, s.size, t.source_size, t.target,
         case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
         cast(('0x' || substr(md5('{SEED}:' || coalesce(cast(s.doc_id as varchar), '')), 1, 13)) as bigint)
           / 4503599627370496.0::double as draw
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from rated
"""
