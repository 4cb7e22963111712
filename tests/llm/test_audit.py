import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oracle import connect, differences
from riverdeck.llm.audit import AUDIT_SQL, COUNTS, audit, contracted, steps, tensors, EITHER, FAILED, PASSED

LONG = " ".join(f"w{k}" for k in range(250))


@pytest.fixture(scope="session")
def tables(spark):
    def make(docs, labels):
        d = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr(
            "*", "'x' as part", "'y' as E", "1 as n", "2 as good", "'z' as digest", "true as is_first", "0 as docs")
        return d.repartition(3), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr(
            "*", "'x' as lang", "'y' as text")
    return make


def brute(docs, labels):
    """Every order applied to every document, one filter after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    facts = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)}
        facts.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in facts}:
        own = [f[1:] for f in facts if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[0] for x in own) - len(gone), sum(x[0] == {f} for x in own),
                    sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(frame):
    rows = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in frame.collect()}
    assert all(len(k) == 3 for k in rows)
    return rows


DOCS = [(1, None, "en"), (2, "", "en"), (3, LONG, "en"), (4, LONG, "de"), (5, LONG, None), (5, LONG, ""),
        (6, LONG + " #", "en"), (7, LONG.upper(), "en"), (8, "a " * 300, "en"), (9, "A# " * 300, "en"),
        (None, LONG, "en"), (None, LONG, "en"), (None, None, None), (3, LONG, "en"), (10, "word " * 199, "fr"),
        (11, "x" * 100_000, "fr"), (12, LONG + " \U0001f600", "fr"), (13, "b\x0bc\x0cd\re " * 70, "fr")]
LABELS = [(3, 1, 0), (4, 1, 1), (5, 0, 1), (5, 1, None), (6, None, 1), (None, 1, 1), (99, 1, 1), (9, 1, 1), (9, 0, 0)]


def test_against_brute_force(tables):
    assert found(audit(*tables(DOCS, LABELS))) == brute(DOCS, LABELS)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)),
                          st.sampled_from([None, "", LONG, LONG + "|", "A " * 300, "B" + LONG, "w " * 201, "c# " * 9]),
                          st.sampled_from([None, "", "en", "de"])), min_size=1, max_size=40),
       st.lists(st.tuples(st.integers(0, 9), st.sampled_from([None, 0, 1]), st.sampled_from([None, 0, 1])), max_size=9))
def test_made_tables(tables, docs, labels):
    assert found(audit(*tables(docs, labels))) == brute(docs, labels)


def test_sql_agrees(spark, sf_dir):
    read = [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")]
    assert differences(audit(*read), connect(sf_dir), AUDIT_SQL) == []


def test_every_part_has_all_orders_and_steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    sizes = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    rows = got.collect()
    assert len(rows) == 600 * len(sizes)
    for order in {r.filter_order for r in rows}:
        for part, n in sizes.items():
            own = sorted((r for r in rows if r.filter_order == order and r.part == part), key=lambda r: r.step)
            assert own[0].kept + own[0].removed == n
            assert all(b.kept + b.removed == a.kept for a, b in zip(own, own[1:]))


def test_tensor_by_hand():
    import pandas as pd
    counts = pd.DataFrame([(True, False, False, False, True, 5, 2, 1), (False, False, False, False, False, 7, 7, 0)],
                          columns=[*"ABCDE", "docs", "good", "toxic"])
    tensor = tensors(counts)["docs"]
    assert tensor.shape == (2, 2, 2, 2, 2) and tensor[1, 0, 0, 0, 1] == 5 and tensor.sum() == 12
    assert contracted(tensor, [FAILED, EITHER, EITHER, EITHER, PASSED]) == 0
    assert contracted(tensor, [EITHER] * 5) == 12
    rows = {(o, s): r for o, s, *r in steps(counts)}
    assert rows["ABCDE", 1] == [7, 5, 0, 0, 2, 1, 300] and rows["ABCDE", 5] == [7, 0, 5, 0, 0, 0, 300]
    assert np.array_equal(PASSED + FAILED, EITHER)


def test_empty_tables(tables):
    docs, labels = tables([], [])
    assert audit(docs, labels).count() == 0
    assert found(audit(tables(DOCS, [])[0], labels)) == brute(DOCS, [])


def test_hot_copies(tables):
    docs = [(k, LONG if k % 3 else f"{k} {LONG}", "en") for k in range(300)]
    got = found(audit(*tables(docs, [(k, 1, 0) for k in range(0, 300, 7)])))
    assert got["en", "EABCD", 1][:2] == (101, 199)
