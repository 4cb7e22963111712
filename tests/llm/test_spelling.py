import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverdeck.llm.spelling import (FACTOR, LEAST_COUNT, LEAST_LENGTH, TYPO_EVERY, frequent_words, in_slices, numbered,
                                    roots, spelling_report, trie_nodes, variants)


def counted(rows):
    """(doc_id, text) -> words and their counts, straight from the definition."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % TYPO_EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= LEAST_LENGTH and c >= LEAST_COUNT}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(n):
    """Every word against every other."""
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= FACTOR * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def found(frame):
    rows = frame.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


@pytest.fixture(scope="session")
def words(spark):
    return lambda n: spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(3)


def test_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = counted([(r.doc_id, r.text) for r in docs.collect()])
    assert len(n) > 300
    assert found(spelling_report(docs)) == brute(n)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=6, max_size=9), st.integers(5, 4000), min_size=1, max_size=60))
def test_small_alphabets(words, n):
    assert found(variants(words(n))) == brute(n)


def test_all_words_of_two_letters(words):
    n = {w: 5 + k * k for k, w in enumerate(sorted({format(x, f"0{size}b").replace("0", "a").replace("1", "b")
                                                     for size in (6, 7) for x in range(2 ** size)}))}
    assert found(variants(words(n))) == brute(n)


def test_chains_ties_and_runs(words):
    n = {"abcdef": 5, "abcdex": 25, "abcdxx": 125, "abcxxx": 625, "abxxxx": 3125, "axxxxx": 15625,
         "mmmmmm": 50, "mmmmmmm": 10, "mmmmmmmm": 2 * LEAST_COUNT, "tieaaa": 5, "tieaab": 30, "tieaac": 30, "lonely": 9}
    got = found(variants(words(n)))
    assert got == brute(n)
    assert got["abcdef"][:2] == ("abcdex", "axxxxx") and got["tieaaa"][0] == "tieaab"
    assert got["mmmmmmm"] == ("mmmmmm", "mmmmmm", 10, 2, 50) and got["lonely"] == (None, "lonely", 9, 0, None)


def test_texts(make_docs):
    long = "y" * 30_000
    rows = [(1, "Colour colour COLOUR colour colour-colour color_color "), (2, "colours " * 30), (3, None), (4, ""),
            (None, "Étééééé " * 7), (5, "ab1cdefgh " * 9), (6, "naïveté naivetés " * 6),
            (7, (long + " ") * 5 + (long + "z ") * 30), (8, "×÷×÷×÷ " * 5), (1, "colour " * 9), (1, "colour " * 9)]
    n = counted(rows)
    assert long in n
    got = found(spelling_report(make_docs([(i, t, "s") for i, t in rows])))
    assert got == brute(n)
    assert got["colour"][0] is None and got[long][0] == long + "z"


def test_letters_go_missing(make_docs):
    rows = [(k, "alphabet betagamma deltaeps zetaetas thetaiota kappalam") for k in range(900)]
    got = found(spelling_report(make_docs([(i, t, "s") for i, t in rows])))
    assert got == brute(counted(rows))
    plain = frequent_words(make_docs([(i, t, "s") for i, t in rows]))
    assert {r.word: r.n for r in plain.collect()} == dict.fromkeys(rows[0][1].split(), 900)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab", max_size=7), min_size=1, max_size=50), st.lists(st.integers(1, 6), min_size=1, max_size=30))
def test_nodes_are_prefixes_however_the_words_are_sliced(own, sizes):
    rest, slices = sorted(own), []
    while rest:
        size = sizes[len(slices) % len(sizes)]
        slices.append(rest[:size])
        rest = rest[size:]
    bounds = [(3 * k, s[0], s[-1]) for k, s in enumerate(slices)]
    node_of, prefix_of = {}, {}
    for k, s in enumerate(slices):
        for word, path in zip(s, trie_nodes(s, 3 * k, bounds), strict=True):
            assert len(path) == len(word) + 1
            for depth, node in enumerate(path):
                assert node_of.setdefault(word[:depth], node) == node
                assert prefix_of.setdefault(node, word[:depth]) == word[:depth]


def test_numbering_on_slices(spark):
    random.seed(3)
    own = sorted({"".join(random.choices("abc", k=random.randint(6, 12))) for _ in range(2000)})
    slices = in_slices(spark.createDataFrame([(w,) for w in own], "word string"), len(own))
    assert [r.word for r in slices.orderBy("id").collect()] == own
    node_of = {}
    for r in numbered(slices).join(slices, "id").collect():
        for depth, node in enumerate(r.nodes):
            assert node_of.setdefault(r.word[:depth], node) == node
    assert len(set(node_of.values())) == len(node_of)


def test_roots_of_the_longest_chain(spark):
    steps = 13
    forms = spark.createDataFrame([(k, k + 1) for k in range(steps)], "id bigint, form bigint")
    assert {r.root for r in roots(forms, FACTOR ** (steps + 1)).collect()} == {steps}


def test_empty(make_docs):
    assert spelling_report(make_docs([])).count() == 0
    assert spelling_report(make_docs([(1, None, "s"), (2, "a bc 12", "s")])).count() == 0
    docs = make_docs([(k, "plural plurals", "s") for k in range(5)]).withColumn("n", F.lit(1)).withColumn("word", F.lit("x"))
    assert set(found(spelling_report(docs))) == {"plural", "plurals"}
