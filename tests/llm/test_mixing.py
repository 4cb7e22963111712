import pytest

from riverdeck.llm.mixing import MOST_REPEATS, mix, mixing_report, source_targets


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 100), ("c", 1000), (None, 0)], "source string, size bigint")
    got = {r.source: r for r in source_targets(sizes).collect()}
    # weights a 5, b 2, c 1, null 5 (first of the next round); a stops at 300, c and b share 900 by 1 : 2, b stops at 300
    assert {k: r.target for k, r in got.items()} == pytest.approx({"a": 300, "b": 300, "c": 600, None: 0})
    assert got[None].rate == 0


def test_no_target_above_its_cap_and_all_words_given(spark):
    rows = [(f"s{k:02d}", (k * 37) % 101 + 1) for k in range(23)]
    got = source_targets(spark.createDataFrame(rows, "source string, size bigint")).collect()
    assert sum(r.target for r in got) == pytest.approx(sum(s for _, s in rows))
    assert all(r.target <= MOST_REPEATS * r.source_size + 1e-9 for r in got)


def test_hot_source_comes_near_its_target_and_reruns_agree(make_docs):
    rows = [(k, "word " * (k % 7 + 1), "hot" if k % 3 else f"s{k % 10}") for k in range(6000)]
    first = sorted(map(tuple, mixing_report(make_docs(rows)).collect()))
    assert first == sorted(map(tuple, mixing_report(make_docs(rows[::-1])).collect()))
    taken, target, variance = {}, {}, {}
    for (_, size, source_size, goal, n), (_, _, source) in zip(first, rows):
        assert n <= 3 * size
        part = goal / source_size % 1
        taken[source] = taken.get(source, 0) + n
        target[source] = goal
        variance[source] = variance.get(source, 0) + part * (1 - part) * size ** 2
    for source, goal in target.items():  # independent draws: within four standard deviations
        assert abs(taken[source] - goal) <= 4 * variance[source] ** 0.5 + 1e-6


def test_edges(make_docs):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "z", "b")]
    docs = make_docs(rows)
    got = sorted([tuple(r) for r in mixing_report(docs).collect()], key=str)
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 0, 0), (2, 0, 0), (3, 2, 4), (3, 2, 4), (None, 1, 1)]
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    taken = sum(r[4] for r in got)
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == taken
    assert mix(make_docs([])).count() == mixing_report(make_docs([])).count() == 0
