import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from riverdeck.llm import simhash
from riverdeck.llm.components import components
from riverdeck.llm.simhash import bucket_links, drop_near_copies, near_copies, near_copy_report


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(pairs, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_pairs(fps):
    ids = sorted(fps)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fps[a] ^ fps[b]).bit_count() <= 3]


def test_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fps = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    roots = grouped(near_pairs(fps), fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_copy_report(docs).collect()}
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}
    kept = sorted(r.doc_id for r in drop_near_copies(docs).collect())
    assert kept == sorted(set(roots.values()))


def test_edges(make_docs):
    rows = [(5, None, "a"), (4, "", "a"), (9, " \n\t", None), (7, "Two Words", "a"), (8, "two\nwords", "b"), (3, "ÀB c d", "b"),
            (3, "ÀB c d", "b"), (None, "only here in the text", "b"), (None, "x", "c"), (2, "x", "c"), (6, "w " * 200_000, "c")]
    docs = make_docs(rows)
    fps = [fingerprint(t) for _, t, _ in rows]
    got = sorted([tuple(r) for r in near_copy_report(docs).collect()], key=str)
    ids = {f: min([i for (i, _, _), g in zip(rows, fps) if g == f and i is not None], default=None) for f in fps}
    assert got == sorted([(i, f"{f:016x}", ids[f]) for (i, _, _), f in zip(rows, fps)], key=str)
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [2, 3, 4, 6, 7, None]
    assert near_copies(make_docs([])).count() == drop_near_copies(make_docs([])).count() == 0


def test_links_of_planted_fingerprints(spark):
    pick = random.Random(4)
    fps = []
    for _ in range(60):
        fps.append(pick.getrandbits(64))
        for bits in (1, 2, 3, 4, 5):
            fps.append(fps[-1 if bits > 3 else -bits] ^ sum(1 << b for b in pick.sample(range(64), bits)))
    frame = spark.createDataFrame([(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in fps], "fp bigint")
    got = {r.fp % 2 ** 64: r.root for r in simhash.classes(frame).collect()}
    mine = grouped(near_pairs(dict(enumerate(fps))), range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            assert (got[fps[a]] == got[fps[b]]) == (mine[a] == mine[b])


def test_large_bucket_keeps_all_links(monkeypatch):
    monkeypatch.setattr(simhash, "LARGE_BUCKET", 8)
    pick = random.Random(6)
    high = 0xABCDEF01 << 32
    members = sorted({high ^ (pick.randrange(40) * 0x01010101) ^ (1 << pick.randrange(32)) for _ in range(300)})
    a, b = bucket_links(np.array(members, np.uint64))
    expected = grouped([(x, y) for x, y in near_pairs(dict(enumerate(members)))], range(len(members)))
    at = {m: k for k, m in enumerate(members)}
    assert grouped([(at[int(x)], at[int(y)]) for x, y in zip(a, b)], range(len(members))) == expected


def test_components_of_chains_hubs_and_loops(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{k: 1 for k in range(2, 41)}, **{k: 100 for k in range(101, 160)}, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).filter(F.lit(True)).count() == 0
