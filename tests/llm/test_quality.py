import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverdeck.llm.quality import MEASURED_RULES, RULES, keep_good, plan_cascade, quality_report

PROSE = " ".join(f"sentence{k} goes" for k in range(40))


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k:k + 8]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + j for p in places for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


TEXTS = [None, "", "   \n\t", "one", PROSE, PROSE + " " + PROSE, "a b c d e f g h " * 3, "# " * 30, "x " * 500,
         "line one here\n" * 12, "é ü\U0001f600 " * 25, "w" * 5000 + " v" * 30, "a\x0bb\x0cc\rd " * 9, PROSE + "\n" + PROSE]


def test_figures_against_brute_force(make_docs):
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)]
    got = {r.doc_id: tuple(r)[1:] for r in quality_report(make_docs(rows)).collect()}
    assert {k: g[:6] for k, g in got.items()} == {k: brute(t) for k, t, _ in rows}
    assert got[4][6] and not got[5][6]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "\n", "c "]), max_size=60).map(" ".join), min_size=1, max_size=30))
def test_small_alphabets(make_docs, texts):
    got = {r.doc_id: tuple(r)[1:7] for r in quality_report(make_docs(list(zip(range(99), texts, ["s"] * 99)))).collect()}
    assert got == {k: brute(t) for k, t in enumerate(texts)}


def test_verdict_is_that_of_all_rules_in_any_order(make_docs):
    docs = make_docs([(k, t, "s") for k, t in enumerate(TEXTS)])
    expected = docs
    for rule in RULES:
        expected = expected.filter(~rule.rejects(F.coalesce("text", F.lit(""))))
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in expected.collect())
    assert sorted(r.doc_id for r in quality_report(docs).filter("kept").collect()) == sorted(
        r.doc_id for r in kept.collect())
    assert [r.name for r in RULES] == [r.name for r in MEASURED_RULES]


def test_order_is_rejection_per_cost(make_docs):
    found = plan_cascade(make_docs([(k, "too short", "s") for k in range(50)]))
    assert [f["worth"] for f in found] == sorted([f["worth"] for f in found], reverse=True)
    assert found[0]["selectivity"] == 1.0


def test_empty_and_repeated(make_docs):
    assert quality_report(make_docs([])).count() == keep_good(make_docs([])).count() == 0
    assert keep_good(make_docs([(1, PROSE, None), (1, PROSE, None), (None, PROSE, "s")])).count() == 3


def test_hashed_share(spark):
    from riverdeck.llm.columns import hashed_share
    n = 100_000
    hashes = spark.range(n).select(F.xxhash64("id").alias("h"))
    for share in (0.0, 1e-3, 0.25, 1.0):
        assert abs(hashes.filter(hashed_share(F.col("h"), share)).count() - share * n) <= 5 * (share * n) ** 0.5
    tiny = spark.createDataFrame([(-2 ** 63,), (-2 ** 63 + 10 ** 8,), (0,)], "h bigint")
    assert tiny.filter(hashed_share(F.col("h"), 1e-11)).count() == 2
