import collections
import hashlib
import random

import numpy as np
import pytest

from riverdeck.llm import repeats
from riverdeck.llm.repeats import factors, remove_repeats, repeats_report


def brute(rows, length, keep_first):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    count, first = collections.Counter(), {}
    for k in order:
        data = (rows[k][1] or "").encode()
        for p in range(len(data) - length + 1):
            count[data[p:p + length]] += 1
            first.setdefault(data[p:p + length], (k, p))
    out = []
    for k, (doc_id, text, _) in enumerate(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            piece = data[p:p + length]
            if first[piece] != (k, p) if keep_first else count[piece] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and (not p or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, kept))
    return sorted(out, key=str)


def made(seed, n):
    pick = random.Random(seed)
    para = lambda size: "".join(pick.choice("abcdeé ") for _ in range(size))
    shared = [para(pick.randint(300, 900)) for _ in range(5)]
    rows = [(k, "".join(pick.choice([para(pick.randint(0, 300)), pick.choice(shared)[pick.randint(0, 100):],
                                     pick.choice(shared), "ab" * pick.randint(0, 400)]) for _ in range(pick.randint(0, 5))), "s")
            for k in range(n)]
    return rows + [(1000 + k, shared[0] + shared[1], "hot") for k in range(40)] + [
        (2000, None, "s"), (2001, "", "s"), (None, shared[2], "s"), (2002, "x" * 1500, "s"), (2003, "x" * 900, None)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [repeats.GROUP, 2])
def test_against_brute_force(make_docs, monkeypatch, keep, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    monkeypatch.setattr(repeats, "STRETCHES", 3000)
    rows = made(7, 60)
    got = remove_repeats(make_docs(rows), keep=keep).collect()
    assert sorted([tuple(r)[:4] + (bytes(r.kept),) for r in got], key=str) == brute(rows, 400, keep == "first")


def test_runs_do_not_depend_on_where_a_text_is_cut(monkeypatch):
    pick = np.random.default_rng(1)
    data = pick.integers(97, 101, 5000, np.uint8).tobytes()
    low, high = (np.concatenate(x) for x in list(zip(*repeats.runs(data)))[3:])
    assert low[0] == 0 and high[-1] == len(data) - 400 and (low[1:] == high[:-1] + 1).all()
    monkeypatch.setattr(repeats, "PLACES", 500)
    low, high = (np.concatenate(x) for x in list(zip(*repeats.runs(data)))[3:])
    assert low[0] == 0 and high[-1] == len(data) - 400 and (low[1:] == high[:-1] + 1).all()


def test_factors_are_previous_and_next_matches():
    order, earlier, later = factors(np.array([5, 3, 5, 3, 5, 9], np.uint64), np.array([24, 10, 19, 12, 27, 13]))
    seen = {int(k): (bool(e), bool(n)) for k, e, n in zip(order, earlier, later)}
    assert seen == {1: (False, True), 3: (True, False), 2: (False, True), 0: (True, True), 4: (True, False), 5: (False, False)}


@pytest.mark.parametrize("first_stays", [False, True])
def test_distances_against_brute_force(first_stays):
    """Short strings around made anchors, of few letters, in groups of several sizes."""
    length, gram, pick = 20, 4, random.Random(3)
    for n in (1, 2, 30, 300):
        group, behind, ahead, pieces = [], [], [], []
        for _ in range(n):
            least = pick.randint(0, length - gram)
            most = pick.randint(least, length - gram)
            group.append(pick.randint(0, 3))
            behind.append(most)
            ahead.append(least)
            letters = lambda size: "".join(pick.choices("ab", [20, 1], k=size))
            pieces.append((letters(most) + pick.choice(["aaaa", "aaab"]) + letters(length - gram - least)).encode())
        seen = collections.defaultdict(list)
        for k in range(n):
            for d in range(ahead[k], behind[k] + 1):
                seen[group[k], d, pieces[k][behind[k] - d:behind[k] - d + length]].append(k)
        expected = collections.defaultdict(list)
        for (_, d, _), holders in seen.items():
            for k in holders[1:] if first_stays else holders if len(holders) > 1 else []:
                expected[k].append(d)
        least, largest = repeats.repeated_distances(
            np.array(group), np.array(behind), np.array(ahead), pieces, np.arange(n), first_stays, length, gram)
        assert [(min(expected[k], default=-1), max(expected[k], default=-1)) for k in range(n)] == list(zip(least, largest))


def test_texts_of_equal_polynomial_hash_stay(make_docs):
    """Two texts whose difference is 0 for polynomial hashes modulo 2^64, whatever their base: a product of x^m - 1."""
    difference = np.ones(1, int)
    for m in (1, 2, 3, 4, 5, 6, 8, 12, 16, 24, 32, 48, 64, 96):
        factor = np.zeros(m + 1, int)
        factor[[0, m]] = -1, 1
        difference = np.convolve(difference, factor)
    tail = "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyz", k=400 - difference.size))
    one, other = ("".join(chr(ord("j") + int(max(c, 0))) for c in part) + tail for part in (difference, -difference))
    assert one != other and len(one) == len(other) == 400
    got = remove_repeats(make_docs([(1, one, "s"), (2, other, "s"), (3, "x" + other, "s")]), keep="none").collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 400, 3: 400}


@pytest.mark.parametrize("keep", ["none", "first"])
def test_a_hot_passage_in_differing_texts(make_docs, monkeypatch, keep):
    """One passage in all texts, with surroundings that agree for some bytes: its anchors hold all of them."""
    monkeypatch.setattr(repeats, "GROUP", 4)
    pick = random.Random(5)
    word = lambda size: "".join(pick.choices("abcdefgh", k=size))
    passage, before, after = word(300), word(200), word(200)
    rows = [(k, word(50) + before[pick.randint(0, 200):] + passage + after[:pick.randint(0, 200)] + word(50), "s") for k in range(60)]
    got = remove_repeats(make_docs(rows), keep=keep).collect()
    assert sorted([tuple(r)[:4] + (bytes(r.kept),) for r in got], key=str) == brute(rows, 400, keep == "first")


def test_report_of_a_table(spark, sf_dir):
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows, 400, False)]
    got = repeats_report(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_repeated_rows_and_empty_table(make_docs):
    text = "".join(random.Random(2).choices("abcdefgh", k=1000))
    rows = [(1, text, "s"), (1, text, "s")]
    assert [r.n_removed for r in remove_repeats(make_docs(rows), keep="none").collect()] == [1000, 1000]
    assert [r.n_removed for r in remove_repeats(make_docs(rows), keep="first").collect()] == [0, 0]
    assert remove_repeats(make_docs([])).count() == 0


def test_no_batch_of_texts_outgrows_its_bytes(spark, make_docs, monkeypatch):
    """The rows that Python gets together are bounded by bytes, and texts to pack or to cut go row by row."""
    monkeypatch.setattr(repeats, "BATCH", 20_000, raising=False)
    pick = random.Random(6)
    word = lambda size: "".join(pick.choices("abcdefgh", k=size))
    passage = word(800)
    docs, name = make_docs([(k, word(600) + passage + word(600), "s") for k in range(300)]), "spark.sql.execution.arrow.maxBytesPerBatch"
    real, before = type(docs).mapInPandas, spark.conf.get(name, None)

    def watched(self, func, schema, *more):
        def run(batches):
            def checked():
                for batch in batches:
                    size = sum(len(x) for c in ("payload", "packed", "piece") if c in batch for x in batch[c])
                    assert size < 60_000, size
                    yield batch
            return func(checked())
        return real(self, run, schema, *more)

    monkeypatch.setattr(type(docs), "mapInPandas", watched)
    got = remove_repeats(docs, keep="none")
    assert "ArrowEvalPython" not in got._jdf.queryExecution().toString()
    assert spark.conf.get(name, None) == before
    rows = got.collect()
    assert len(rows) == 300 and all(r.n_removed >= 800 and r.n_spans == 1 for r in rows)
