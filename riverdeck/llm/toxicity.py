"""Toxicity by weak supervision: voters, a label model over them, a linear classifier on its posteriors.

Voters are single words of a fixed lexicon, patterns (insults addressed to someone, shouting, masked words
...) and word stems found on labelled rows: those that most set toxic documents apart. The label given to a
row is one more voter, not the truth. `label_model` estimates how far each voter is right and which depend on
each other, and gives each row a posterior. A logistic regression (Spark ML, elastic net) is trained on those
soft labels; its features are the presence of stems, words and patterns. Scores are its probabilities.

Training rows are labelled, and not held out (`held_out`: the crc32 of doc_id leaves 1 modulo 3): up to
`MOST_OF_A_CLASS` toxic and as many other documents, those with the smallest hash of their doc_id, weighted
back to the share their class has. One text counts once. Every lexicon word alone is added as a toxic text,
and as many empty texts as clean ones, so the lexicon decides where there are no labels at all. Scoring
reads every text whole, row by row, with no shuffle; the model is at most `MOST_FEATURES` weights.

Defined cases: a null text is empty; a null doc_id is hashed as the empty string, gets a score and trains
nothing; repeated rows are scored each, and of a doc_id's texts the smallest trains; of repeated labels the
largest counts, null ones none; labels without a document are ignored; an empty table gives an empty result.
Of `documents` only doc_id and text are read, of `labels` doc_id and toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverdeck.llm import label_model
from riverdeck.llm.columns import text_or_empty
from riverdeck.llm.shipping import ship
from riverdeck.session import pinned

MOST_OF_A_CLASS = 8_000
MOST_FEATURES = 4_096
MOST_STEM_VOTERS = 64
#: Toxic documents a term needs, and the G statistic (about five standard deviations: chance finds few among all words).
LEAST_DOCUMENTS, LEAST_SURPRISE = 3, 24.0
PREDICTED_FROM = 0.7
#: Strength of the classifier's penalty, and the part of it on absolute weights.
PENALTY, ABSOLUTE = 1e-4, 0.5

#: Common insults.
LEXICON = (
    "idiot", "moron", "stupid", "imbecile", "dumb", "loser", "pathetic", "worthless", "clown", "scum", "trash",
    "disgusting", "filth", "vermin", "bastard", "bitch", "dummkopf", "trottel", "abschaum", "arschloch", "dreckig",
    "imbécile", "crétin", "connard", "minable", "salope", "idiota", "estúpido", "imbécil", "basura", "asqueroso",
    "gilipollas")

WORDS = re.compile(r"[^\W\d_]+")
_INSULT = "|".join(LEXICON)
PATTERNS = {
    "addressed": re.compile(rf"\b(?:you|your|du|ihr|tu|vous|tú|usted)\b[^.!?\n]{{0,60}}?\b(?:{_INSULT})", re.I),
    "many_marks": re.compile(r"!!|\?!"),
    "masked": re.compile(r"[A-Za-z]\*{2,}[A-Za-z]?"),
    "stretched": re.compile(r"([A-Za-z])\1{3}"),
    "digits_for_letters": re.compile(r"\b[A-Za-z]+[013457@$]+[A-Za-z]+\b"),
    "shouted": re.compile(r"[A-Z]{4,}[^a-z\n]{1,20}[A-Z]{4,}"),
}
#: Lengths of the stems a word has, beside the whole word.
STEMS = (3, 4, 5, 6)
WHOLE = "$"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def terms(text: str) -> set[str]:
    """Stems and whole words of a text, in lower case, and the patterns that it meets as `~name`."""
    found = set()
    for word in {w.group().lower() for w in WORDS.finditer(text)}:
        found.add(word[:64] + WHOLE)
        for n in STEMS:
            if len(word) >= n:
                found.add(word[:n])
    found.update("~" + name for name, pattern in PATTERNS.items() if pattern.search(text))
    return found


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_OF_A_CLASS) -> DataFrame:
    """(at, toxic, weight, text): the labelled rows that train, and the lexicon."""
    spark = docs.sparkSession
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    known = pinned(known, "labelled")
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    chosen = None
    for toxic, n in sorted(sizes.items()):
        own = known.filter(F.col("toxic") == toxic).orderBy(order, "doc_id").limit(most).withColumn(
            "weight", F.lit(n / min(n, most)))
        chosen = own if chosen is None else chosen.unionByName(own)
    lexicon = [(1, 1.0, word) for word in LEXICON] + [(0, 1.0, "")] * len(LEXICON)
    added = spark.createDataFrame(lexicon, "toxic int, weight double, text string")
    if chosen is None:
        return pinned(added.withColumn("at", F.monotonically_increasing_id()), "training")
    # At most 2 * `most` rows of three numbers.
    texts = (docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(pinned(chosen, "chosen")), "doc_id")
             .groupBy("doc_id", "toxic", "weight").agg(F.min("text").alias("text"))
             .dropDuplicates(["text", "toxic"]).select("toxic", "weight", "text"))
    return pinned(texts.unionByName(added).withColumn("at", F.monotonically_increasing_id()), "training")


def surprise(toxic: float, other: float, all_toxic: float, all_other: float) -> float:
    """G statistic of a term found in so many toxic and other documents; 0 unless it is commoner among toxic ones."""
    if toxic * all_other <= other * all_toxic:
        return 0.0
    found, everything = toxic + other, all_toxic + all_other
    g = 0.0
    for seen, row, column in ((toxic, found, all_toxic), (other, found, all_other),
                              (all_toxic - toxic, everything - found, all_toxic),
                              (all_other - other, everything - found, all_other)):
        if seen > 0:
            g += 2 * seen * math.log(seen * everything / (row * column))
    return g


def telling_terms(rows: DataFrame, most: int = MOST_FEATURES) -> list[str]:
    """The terms that tell toxic training rows from others, most telling first."""
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch["toxic"], batch["text"]):
                seen[toxic].update(terms(text))
            yield pd.DataFrame([(t, seen[1][t], seen[0][t]) for t in seen[0].keys() | seen[1].keys()],
                               columns=["term", "toxic", "other"])

    all_toxic, all_other = float(totals.get(1, 0)), float(totals.get(0, 0))
    by_term = (rows.select("toxic", "text").mapInPandas(counted, "term string, toxic bigint, other bigint")
               .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
               .filter((F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("toxic") * all_other > F.col("other") * all_toxic)))

    @F.pandas_udf("double")
    def score(toxic: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([surprise(t, o, all_toxic, all_other) for t, o in zip(toxic, other)])

    best = by_term.select("term", score("toxic", "other").alias("g")).filter(F.col("g") >= LEAST_SURPRISE).orderBy(
        F.col("g").desc(), F.length("term"), "term").limit(most)
    return [r.term for r in best.collect()]


def stem_voters(telling: list[str], most: int = MOST_STEM_VOTERS) -> list[str]:
    """Of the telling terms the first `most`, each no stem or extension of one before."""
    chosen: list[str] = []
    for term in telling:
        bare = term.rstrip(WHOLE)
        if not term.startswith("~") and not any(bare.startswith(c) or c.startswith(bare) for c in chosen):
            chosen.append(bare)
            if len(chosen) == most:
                break
    return chosen


@dataclass
class Model:
    """A linear classifier over `terms`; `voters` and their estimated accuracies tell what it was taught by."""

    weights: dict[str, float]
    intercept: float
    voters: list[str] = field(default_factory=list)
    accuracies: list[float] = field(default_factory=list)

    def score(self, text: str) -> float:
        odds = self.intercept + sum(sorted(self.weights[t] for t in terms(text) if t in self.weights))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, odds))))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    ship(spark)
    rows = training_rows(docs, labels)
    telling = telling_terms(rows)
    voters = [w + WHOLE for w in LEXICON] + ["~" + name for name in PATTERNS]
    voters += [v for v in stem_voters(telling) if v + WHOLE not in voters]
    features = list(dict.fromkeys(telling + voters))[:MOST_FEATURES + len(LEXICON) + len(PATTERNS) + MOST_STEM_VOTERS]
    place = {t: k for k, t in enumerate(features)}

    def hit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [sorted(place[t] for t in terms(text) if t in place) for text in batch["text"]]
            yield pd.DataFrame({"at": batch["at"], "toxic": batch["toxic"], "weight": batch["weight"], "hits": own})

    hits = pinned(rows.mapInPandas(hit, "at bigint, toxic int, weight double, hits array<int>"), "hits")
    # Bounded by the parameters above: rows of the sample x voters.
    voting = [place[v] for v in voters]
    voted = F.array_intersect("hits", F.array(*map(F.lit, voting))).alias("hits")
    seen = hits.select("at", "toxic", "weight", voted).orderBy("at").collect()
    column = {k: j for j, k in enumerate(voting)}
    votes = np.zeros((len(seen), len(voters)), np.int64)
    for k, row in enumerate(seen):
        votes[k, [column[h] for h in row.hits]] = 1
    weights = np.array([row.weight for row in seen])
    votes = np.column_stack([votes, [row.toxic for row in seen]])
    believed = label_model.fit(votes, weights)
    soft = spark.createDataFrame(pd.DataFrame({"at": [row.at for row in seen], "q": believed.posterior(votes)}),
                                 "at bigint, q double")

    @F.udf(VectorUDT())
    def vector(found: list[int]):
        return Vectors.sparse(len(features), found, [1.0] * len(found))

    each = pinned(hits.join(soft, "at").select("weight", "q", vector("hits").alias("features")), "soft_labels")
    both = each.select("features", F.lit(1.0).alias("label"), (F.col("weight") * F.col("q")).alias("w")).unionByName(
        each.select("features", F.lit(0.0).alias("label"), (F.col("weight") * (1 - F.col("q"))).alias("w")))
    learned = LogisticRegression(featuresCol="features", labelCol="label", weightCol="w", maxIter=100,
                                 regParam=PENALTY, elasticNetParam=ABSOLUTE).fit(both.filter("w > 0"))
    weight = learned.coefficients.toArray()
    return Model({t: float(weight[k]) for t, k in place.items() if weight[k]}, float(learned.intercept),
                 [*voters, "label"], believed.accuracies(votes, weights).tolist())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(text) for text in texts], dtype="float64")

    out = docs.select("doc_id", score(text_or_empty()).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, train(docs, labels))
