import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverdeck.llm import label_model
from riverdeck.llm.toxicity import (LEXICON, PREDICTED_FROM, held_out, scored, stem_voters, surprise, telling_terms, terms,
                                    toxicity_report, train, training_rows)


@pytest.fixture(scope="session")
def labelled(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id bigint, toxic int")
        return df.withColumn("quality", F.lit(1)).withColumn("text", F.lit("x")).withColumn("score", F.lit(0.5))
    return make


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3


def corpus(n=600):
    """Every sixth document holds words of a stem that no lexicon has."""
    docs, labels = [], []
    for k in range(n):
        words = [f"plain{'abcdefghij'[k * j % 10]}{'klmnop'[(k + j) % 6]}" for j in range(20)]
        if k % 6 == 0:
            words[3 + k % 9] = f"zorgul{'abcdef'[k // 6 % 6]}"
        docs.append((k, " ".join([*words, str(k)]), f"s{k % 3}"))
        labels.append((k, int(k % 6 == 0)))
    return docs, labels


def test_held_out_accuracy(spark, sf_dir):
    """The largest table of the set that a test can bear: its labels are noisy, its stems in four languages."""
    folder = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.1")
    if not os.path.isdir(folder):
        pytest.skip("no larger table")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = scored(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), train(docs, labels)).filter("held_out").join(
        labels, "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert len(toxic) > 100 and len(clean) > 1000
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.75
    assert sum(r.predicted for r in clean) / len(clean) <= 0.005
    ranked = sorted(r.score for r in clean)
    above = [np.searchsorted(ranked, r.score) / len(ranked) for r in toxic]
    assert np.mean(above) >= 0.93


def test_stems_that_no_lexicon_has_are_found(spark, make_docs, labelled):
    docs, labels = corpus()
    model = train(make_docs(docs), labelled(labels))
    assert any(t.startswith("zor") for t in model.weights)
    got = {r.doc_id: r for r in scored(make_docs(docs), model).collect()}
    assert all(got[k].held_out == (crc(k) == 1) for k, _, _ in docs)
    assert all(got[k].predicted == toxic for k, toxic in labels)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= PREDICTED_FROM) for r in got.values())
    assert model.score("quite new zorgulf words") > PREDICTED_FROM > model.score("quite new words")


def test_held_out_labels_and_other_columns_teach_nothing(make_docs, labelled):
    docs, labels = corpus(300)
    first = {r.doc_id: r.score for r in toxicity_report(make_docs(docs), labelled(labels)).collect()}
    turned = [(k, 1 - t if crc(k) == 1 else t) for k, t in labels]
    moved = [(k, text, "elsewhere") for k, text, _ in docs]
    again = {r.doc_id: r.score for r in toxicity_report(make_docs(moved), labelled(turned)).collect()}
    assert again == pytest.approx(first, abs=1e-6)


def test_edges(make_docs, labelled):
    rows = [(1, None, "s"), (2, "", "s"), (None, "you idiot", "s"), (3, "You pathetic MORON!", None), (3, "You pathetic MORON!", None),
            (4, "fine words", "s"), (5, "nice " * 200_000, "s"), (6, "x" * 300_000, "s"), (7, "\x00퟿ é\n", "s")]
    strange = [(1, None), (2, 5), (None, 1), (99, 1), (3, 1), (3, 0)]
    for labels in ([], strange, [(4, 0)], [(3, 1)]):
        got = toxicity_report(make_docs(rows), labelled(labels)).collect()
        assert len(got) == len(rows)
        by_id = {r.doc_id: r for r in got}
        assert by_id[3].predicted == by_id[None].predicted == 1
        assert not any(by_id[k].predicted for k in (1, 2, 4, 5, 6, 7))
        assert by_id[None].held_out is False and by_id[1].score == by_id[2].score
    assert toxicity_report(make_docs([]), labelled(strange)).count() == 0


def test_training_rows_are_bounded_weighted_and_not_held_out(make_docs, labelled):
    docs, labels = corpus()
    rows = training_rows(make_docs(docs), labelled(labels + labels), most=30).collect()
    texts = {text: k for k, text, _ in docs}
    own = [r for r in rows if r.text not in (*LEXICON, "")]
    assert all(crc(texts[r.text]) != 1 and dict(labels)[texts[r.text]] == r.toxic for r in own)
    for toxic in (0, 1):
        mine = [r for r in own if r.toxic == toxic]
        everyone = sum(t == toxic and crc(k) != 1 for k, t in labels)
        assert len(mine) <= 30 and {r.weight for r in mine} == {everyone / 30}
    assert sum(r.text in LEXICON for r in rows) == len(LEXICON) and len({r["at"] for r in rows}) == len(rows)


def test_held_out_is_the_remainder(spark):
    ids = [0, 7, -3, 10 ** 15, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    assert [r[0] for r in df.select(held_out(F.col("doc_id"))).collect()] == [
        zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1 for i in ids]


def test_terms_by_hand():
    assert terms("Idiot!!") == {"idi", "idio", "idiot", "idiot$", "~many_marks"}
    assert terms("") == set() and "~addressed" in terms("You, my friend, are a clown")
    assert {"~masked", "~stretched", "~digits_for_letters", "~shouted"} <= terms("sh**t soooo id1ot WORD, OTHER")
    assert terms("12 _ ab") == {"ab$"}


def test_telling_terms(spark):
    rows = spark.createDataFrame([(1, 1.0, f"alpha beta{k}") for k in range(40)] + [(0, 1.0, f"gamma beta{k}") for k in range(90)],
                                 "toxic int, weight double, text string")
    assert set(telling_terms(rows)) == {"alp", "alph", "alpha", "alpha$"}
    assert surprise(10, 10, 100, 100) == 0 and surprise(1, 9, 10, 10) == 0
    assert surprise(10, 0, 10, 10) == pytest.approx(2 * 10 * np.log(2) * 2)
    assert stem_voters(["abc", "abcd", "ab", "xyz$", "~masked", "xyzw", "q"], most=3) == ["abc", "xyz", "q"]


def made_votes(rng, n=6000):
    y = rng.random(n) < 0.2
    fires = lambda hit, miss: np.where(y, rng.random(n) < hit, rng.random(n) < miss)
    good, weak = fires(0.9, 0.02), fires(0.3, 0.25)
    copy = np.where(rng.random(n) < 0.02, ~weak, weak)
    anchor = fires(0.98, 0.01)
    return y, np.column_stack([good, weak, copy, copy, fires(0.5, 0.1), anchor]).astype(np.int64)


def test_label_model_finds_accuracies_and_dependence():
    y, votes = made_votes(np.random.default_rng(5))
    ones = np.ones(len(y))
    model = label_model.fit(votes, ones)
    assert model.prior == pytest.approx(0.2, abs=0.02)
    for j in (0, 1, 4):
        assert model.accuracies(votes, ones)[j] == pytest.approx(y[votes[:, j] == 1].mean(), abs=0.05)
    tied = {frozenset((j, p)) for j, p in enumerate(model.parents) if p >= 0}
    assert tied <= {frozenset((1, 2)), frozenset((1, 3)), frozenset((2, 3))} and len(tied) == 2
    assert model.parents[5] == -1
    # Three copies of a weak voter say what one says.
    q = model.posterior(np.array([[0, 0, 0, 0, 0, 1], [0, 1, 1, 1, 0, 1]]))
    alone = label_model.fit(votes[:, [0, 1, 4, 5]], ones).posterior(np.array([[0, 0, 0, 1], [0, 1, 0, 1]]))
    assert q == pytest.approx(alone, abs=0.03)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.98


def test_spanning_forest_by_hand():
    strength = np.array([[0, 9, 1, 0], [9, 0, 5, 0], [1, 5, 0, 2], [0, 0, 2, 0]], float)
    assert label_model.spanning_forest(strength, 4.0) == [-1, 0, 1, -1]
    assert label_model.spanning_forest(strength, 99.0) == [-1] * 4
