"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

Each tree splits at the median projection on a random direction. A query walks all trees through one
priority queue, whose key is the squared distance by which a subtree lies on the far side of the splits
above it, until the leaves found hold enough rows. How many are enough is measured: the exact neighbours of
`PROBES` entries are sought among all entries, and the search goes as far as it takes to meet `RECALL` of them,
though never less far than `LEAST_ROWS`. Candidates
in the leaves are reranked by their exact inner product in double precision. One more coordinate, sqrt(largest norm^2 - norm^2) for
rows and 0 for queries, turns the largest inner product into the smallest distance.

The forest is fitted on the driver, on a sample of at most `FIT_ROWS` vectors; every vector is indexed.
Rows with one vector are one entry with its smallest ids, so copies never share a bucket. Leaves are
gathered in blocks of about `BLOCK_ROWS` entries; a query goes only to blocks in which it visits a leaf, with the list
of those leaves, and takes its best back. A block is sent once per `CHUNK_QUERIES` queries that come to it.

Vectors without direction (independent, as in the test tables) are the worst case: near neighbours are
hardly nearer than others, and a recall of 0.9 takes leaves with about half of all rows.

Defined cases: a vector that is null, empty, zero, holds null or a number that isn't finite, or has another
length than most takes no part; so does a row without id. Equal rows count once. Fewer candidates than
k give fewer rows; an empty table gives none. Only vec_id and embedding are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverdeck.llm.columns import hashed_share
from riverdeck.llm.shipping import ship
from riverdeck.session import pinned

TREES = 6
LEAF_ROWS = 96
#: Entries whose exact neighbours are sought to see how far a search must go, and the part of them it must meet.
PROBES = 256
RECALL = 0.96
#: Rows, over all trees, that the leaves of a search hold at least, so that each finds k of its own.
LEAST_ROWS = 2000
FIT_ROWS = 65_536
BLOCK_ROWS = 65_536
CHUNK_QUERIES = 8192
SEED = 11


@dataclass(frozen=True)
class Tree:
    """Inner nodes by number; a child below 0 is leaf -child - 1. `rows` is a leaf's share of the sample."""

    normals: np.ndarray
    splits: np.ndarray
    children: np.ndarray  # inner nodes x (at most, above)
    rows: np.ndarray


def grow(sample: np.ndarray, rng: np.random.Generator, leaf_rows: int = LEAF_ROWS) -> Tree:
    normals, splits, children, rows = [], [], [], []

    def split(ids: np.ndarray) -> int:
        if len(ids) <= leaf_rows:
            rows.append(len(ids) / max(len(sample), 1))
            return -len(rows)
        normal = rng.standard_normal(sample.shape[1])
        normal /= np.linalg.norm(normal)
        place = sample[ids] @ normal
        middle = np.median(place)
        low = place <= middle
        if low.all():
            rows.append(len(ids) / len(sample))
            return -len(rows)
        at = len(normals)
        normals.append(normal)
        splits.append(middle)
        children.append(None)
        children[at] = (split(ids[low]), split(ids[~low]))
        return at

    split(np.arange(len(sample)))
    d = sample.shape[1]
    return Tree(np.array(normals).reshape(-1, d), np.array(splits), np.array(children, int).reshape(-1, 2), np.array(rows))


@dataclass(frozen=True)
class Forest:
    trees: tuple[Tree, ...]
    norm2: float  # largest squared norm

    def offsets(self) -> list[int]:
        """The number of each tree's first leaf among all leaves."""
        return [0, *np.cumsum([len(t.rows) for t in self.trees]).tolist()]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """vectors x trees: the leaf each vector falls into."""
        lifted = np.c_[vectors, np.sqrt(np.maximum(self.norm2 - (vectors ** 2).sum(1), 0))]
        out = []
        for tree, first in zip(self.trees, self.offsets()):
            node = np.zeros(len(vectors), int) if len(tree.splits) else np.full(len(vectors), -1)
            while (inner := np.flatnonzero(node >= 0)).size:
                at = node[inner]
                above = np.einsum("nd,nd->n", lifted[inner], tree.normals[at]) > tree.splits[at]
                node[inner] = tree.children[at, above.astype(int)]
            out.append(first - node - 1)
        return np.stack(out, 1)

    def search(self, query: np.ndarray, share: float) -> list[int]:
        """Leaves in the order of the shared queue, until they hold `share` of the rows, over all trees."""
        lifted, firsts = np.append(query, 0.0), self.offsets()
        margins = [(t.normals @ lifted - t.splits).tolist() for t in self.trees]
        children = [t.children.tolist() for t in self.trees]
        queue = [(0.0, k, 0 if m else -1) for k, m in enumerate(margins)]
        found, held = [], 0.0
        while queue and held < share:
            cost, k, node = heapq.heappop(queue)
            while node >= 0:
                margin = margins[k][node]
                near = margin > 0
                heapq.heappush(queue, (cost + margin * margin, k, children[k][node][not near]))
                node = children[k][node][near]
            found.append(firsts[k] - node - 1)
            held += self.trees[k].rows[-node - 1]
        return found


def usable(vector: Column) -> Column:
    """Finite throughout, and somewhere not zero."""
    return (F.coalesce(F.size(vector) > 0, F.lit(False))
            & F.forall(vector, lambda x: F.coalesce((x - x) == 0, F.lit(False)))  # null, NaN and infinities fail
            & F.exists(vector, lambda x: x != 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(id, vector) -> one row per vector: key, vector, its k + 1 smallest ids."""
    order = Window.partitionBy("vector").orderBy("id")
    least = rows.dropDuplicates(["id", "vector"]).withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= k + 1)
    return pinned(least.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                  .withColumn("key", F.monotonically_increasing_id()), "entries")


def fit_forest(index: DataFrame, fit_rows: int = FIT_ROWS, trees: int = TREES) -> tuple[Forest, int]:
    """The forest, from at most `fit_rows` vectors chosen by a hash; and how many entries there are."""
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    n, norm2 = index.agg(F.count("*"), F.max(squares)).first()
    share = min(1.0, fit_rows / max(n, 1))
    chosen = index.filter(hashed_share(F.xxhash64("vector"), share))
    found = chosen.orderBy(F.xxhash64("vector"), "vector").select("vector").limit(fit_rows).toArrow()["vector"]
    sample = found.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(found), -1)
    lifted = np.c_[sample, np.sqrt(np.maximum(norm2 - (sample ** 2).sum(1), 0))]
    rng = np.random.default_rng(SEED)
    return Forest(tuple(grow(lifted, rng) for _ in range(trees)), float(norm2)), n


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list())


def _block_of(leaf: np.ndarray, firsts: list[int], blocks: int) -> np.ndarray:
    """Neighbouring leaves of one tree share a block: `blocks` of them per tree."""
    tree = np.searchsorted(firsts, leaf, "right") - 1
    first = np.array(firsts)
    return tree * blocks + (leaf - first[tree]) * blocks // (first[tree + 1] - first[tree])


def fitted_share(index: DataFrame, forest: Forest, k: int, probes: int = PROBES, recall: float = RECALL) -> float:
    """How far a search must go to meet `recall` of the k nearest of `probes` entries, chosen by a hash: the share
    of rows in the leaves visited, over all trees. The probes are held against every entry, a batch at a time."""
    chosen = index.select("key", "vector", F.xxhash64("key").alias("hash")).orderBy("hash", "key").limit(probes).collect()
    if len(chosen) < 2:
        return 1.0
    own = np.array([r["key"] for r in chosen])
    asked = np.array([r["vector"] for r in chosen])

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors, keys = _stack(batch["vector"]), batch["key"].to_numpy()
            score = asked @ vectors.T
            score[own[:, None] == keys] = -np.inf
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            probe, at = np.repeat(np.arange(len(own)), best.shape[1]), best.ravel()
            yield pd.DataFrame({"probe": probe, "key": keys[at], "score": score[probe, at], "leaves": list(forest.leaves(vectors[at]))})

    order = Window.partitionBy("probe").orderBy(F.desc("score"), "key")
    near = (index.select("key", "vector").mapInPandas(nearest, "probe int, key bigint, score double, leaves array<bigint>")
            .filter(F.col("score") > float("-inf")).withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= k).select("probe", "leaves").collect())  # at most `probes` times k
    rows = np.concatenate([t.rows for t in forest.trees])
    reached = {}
    for probe, vector in enumerate(asked):
        order = np.array(forest.search(vector, math.inf))
        reached[probe] = np.empty(len(rows))
        reached[probe][order] = np.cumsum(rows[order])
    needed = np.array([reached[r["probe"]][r["leaves"]].min() for r in near])
    return float(np.quantile(needed, recall, method="higher"))


def search(rows: DataFrame, is_query: Column, k: int, share: float | None = None) -> DataFrame:
    """(id, vector) -> query_id, rank, vec_id, score: the k nearest found of each row that `is_query`. Searches go as far
    as is measured to be needed, or until their leaves hold `share` of the rows."""
    spark = rows.sparkSession
    ship(spark)
    lengths = rows.filter(usable(F.col("vector"))).groupBy(F.size("vector").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    if most is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")) & (F.size("vector") == most["n"]))
    index = entries(rows, k)
    forest, n = fit_forest(index)
    share = fitted_share(index, forest, k) if share is None else share
    firsts, share = forest.offsets(), max(share, max(LEAST_ROWS, 2 * TREES * (k + 1)) / max(n, 1))
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    asked = pinned(rows.filter(is_query).dropDuplicates(["id", "vector"]).join(index.select("key", "vector"), "vector")
                   .select(F.col("id").alias("query_id"), F.col("key").alias("query")), "asked")
    queries = index.join(asked.select(F.col("query").alias("key")).distinct(), "key", "left_semi")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                own = forest.leaves(_stack(batch["vector"]))
                for column in own.T:
                    yield pd.DataFrame({"block": _block_of(column, firsts, blocks), "leaf": column,
                                        "key": batch["key"], "vector": batch["vector"]})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, vector in zip(batch["key"], batch["vector"]):
                found = np.array(forest.search(vector, share))
                block = _block_of(found, firsts, blocks)
                out += [(b, key, vector, found[block == b]) for b in np.unique(block)]
            yield pd.DataFrame(out, columns=["block", "key", "vector", "leaves"])

    def rerank(members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(asking):
            return pd.DataFrame({"query": [], "key": [], "score": []})
        members = members.sort_values("leaf", kind="stable")
        m, q, keys = _stack(members["vector"]), _stack(asking["vector"]), members["key"].to_numpy()
        by_leaf: dict[int, list[int]] = {}
        for at, visited in enumerate(asking["leaves"]):
            for leaf in visited:
                by_leaf.setdefault(int(leaf), []).append(at)
        best = np.full((len(q), k + 1), -np.inf)
        who = np.full((len(q), k + 1), -1)
        starts, number = np.unique(members["leaf"].to_numpy(), return_index=True)
        for leaf, low, high in zip(starts, number, [*number[1:], len(m)]):
            at = np.array(by_leaf.get(int(leaf), []), int)
            if not at.size:
                continue
            score = q[at] @ m[low:high].T
            all_scores = np.c_[best[at], score]
            all_who = np.c_[who[at], np.broadcast_to(np.arange(low, high), score.shape)]
            top = np.argpartition(-all_scores, k, axis=1)[:, :k + 1]
            best[at] = np.take_along_axis(all_scores, top, 1)
            who[at] = np.take_along_axis(all_who, top, 1)
        row, column = np.nonzero(np.isfinite(best))
        chosen = who[row, column]
        return pd.DataFrame({"query": asking["key"].to_numpy()[row], "key": keys[chosen],
                             "score": np.einsum("nd,nd->n", q[row], m[chosen])})  # the same in any block

    routed = pinned(queries.select("key", "vector").mapInPandas(
        route, "block bigint, key bigint, vector array<double>, leaves array<bigint>"), "routed")
    visited = pinned(routed.groupBy("block").agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("int").alias("chunks")), "visited")
    indexed = (index.select("key", "vector")
               .mapInPandas(place, "block bigint, leaf bigint, key bigint, vector array<double>")
               .join(visited, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks"))
    routed = routed.join(visited, "block").withColumn(
        "chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")).drop("chunks")
    found = (indexed.groupBy("block", "chunk").cogroup(routed.groupBy("block", "chunk"))
             .applyInPandas(rerank, "query bigint, key bigint, score double"))
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0]))
    near = (found.groupBy("query", "key").agg(F.max("score").alias("score")).join(index.select("key", "ids"), "key")
            .withColumn("place", first).filter(F.col("place") <= k + 1)
            .select("query", "score", F.explode("ids").alias("vec_id")))
    nearest = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = pinned(near.withColumn("place", nearest).filter(F.col("place") <= k + 1).drop("place"), "near")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return (asked.join(lists, "query").filter(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def neighbour_report(vectors: DataFrame, k: int = 20) -> DataFrame:
    """The nearest of each row whose vec_id is divisible by 20."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    return search(rows, F.col("id") % 20 == 0, k)
