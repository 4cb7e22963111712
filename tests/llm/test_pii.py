import hashlib
import random
import re

import numpy as np

from riverdeck.llm import pii, skip_chain
from riverdeck.llm.pii import base_spans, find, find_personal_data, luhn, personal_data_report, redact

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 12 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_against_plain_patterns():
    pick = random.Random(3)
    for _ in range(20_000):
        text = "".join(pick.choice("0123456789.. --()++@@ab%é\n ") for _ in range(pick.randint(0, 40)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("9" * 300_000, "(" * 300_000, "+" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "@" * 100_000):
        find(text)


def test_same_number_written_another_way():
    text = "Call +1 (988) 555-2485 now. Or dial 988-555-2485, ref 77123456789; bob.42@m.example.com, bob.42 (at) m.example.com"
    spans = [(kind, text[s:e], base) for kind, s, e, base in find(text)]
    assert ("phone", "988-555-2485", False) in spans
    assert ("email", "bob.42 (at) m.example.com", False) in spans
    assert not any("77123456789" in piece for _, piece, _ in spans)


def added(text):
    return [(kind, text[s:e]) for kind, s, e, base in find(text) if not base]


def test_address_without_a_digit_spelled_another_way():
    assert added("alice@example.org, so alice at example dot org") == [("email", "alice at example dot org")]
    assert added("alice@example.org or al [at] example.org") == []
    text = "alice@example.org; +1 (988) 555-2485. Write alice at example dot org. Then dial at noon. 988 555 2485"
    assert added(text) == [("email", "alice at example dot org"), ("phone", "988 555 2485")]


def test_number_followed_by_another_and_in_a_list():
    first = "+1 (988) 555-2485, "
    assert added(first + "dial 988-555-2485. 3 lines") == [("phone", "988-555-2485")]
    assert added(first + "988 555 2485 (988) 555 2485") == [("phone", "988 555 2485"), ("phone", "988) 555 2485")]
    assert added(first + "212 555 1234 988 555 2485 7 988.555.2485 12 345 678 9012") == [
        ("phone", "988 555 2485"), ("phone", "988.555.2485")]
    assert added(first + "98855524853 12, 3 988555248 57") == []
    assert added("+44 20 7946 0958, 020 7946 0958. 12 345") == [("phone", "020 7946 0958")]


def test_evidence_reaches_distant_tokens_only_by_keys():
    text = "+1 (988) 555-2485 " + "filler words " * 3000 + "988 555 2485 and more " + "filler " * 3000 + "(988) 555 2485, 123 456 7890"
    assert [(k, base) for k, *_, base in find(text)] == [("phone", True), ("phone", False), ("phone", False)]


def test_marginals_are_exact_on_a_tree():
    """Three nodes in a chain: compare with the sum over all label sequences."""
    rng = np.random.default_rng(0)
    w = skip_chain.Weights(rng.normal(size=(len(skip_chain.FEATURES), 5)), rng.normal(size=(5, 5)), np.zeros(5))
    x = rng.random((3, len(skip_chain.FEATURES)))
    node = x @ w.node
    p = np.exp(node[0][:, None, None] + node[1][None, :, None] + node[2] + w.chain[:, :, None] + w.chain[None])
    p /= p.sum()
    got = skip_chain.marginals(x, [-1, -1, -1], [], w)
    for at, axes in enumerate([(1, 2), (0, 2), (0, 1)]):
        assert np.allclose(got[at], p.sum(axes), atol=1e-6)


def test_fit_learns_held_out_labels():
    """Weights fitted on one half of made texts label the other half, with the labels hidden."""
    pick = random.Random(8)
    texts = []
    for _ in range(400):
        number = "".join(pick.choice("0123456789") for _ in range(10))
        other = "".join(pick.choice("123456789") for _ in range(10))
        texts.append((f"phone +1 {number[:3]} {number[3:]} then {number[:3]}-{number[3:6]}-{number[6:]} and number {other}", number))
    rows = [r for t, _ in texts[:200] for r in pii.training_rows(t)]
    column = lambda name, kind: np.array([r[name] for r in rows], kind)
    w = skip_chain.fit(column("features", float), column("label", int), column("before", int), column("after", int),
                       column("linked", float))
    right = 0
    for text, number in texts[200:]:
        added = [text[s:e] for _, s, e, base in find(text, w) if not base]
        right += added == [f"{number[:3]}-{number[3:6]}-{number[6:]}"]
    assert right >= 195


def test_table_and_edges(spark, sf_dir, make_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(-1, None), (-2, ""), (-3, "a@b.cd " * 3), (-3, "a@b.cd " * 3), (-4, "x" * 200_000 + " 1.2.3.4")]
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    texts = {r.doc_id: r.text or "" for r in more.collect()}
    names = skip_chain.KINDS
    for r in personal_data_report(more).collect():
        base = brute(texts[r.doc_id])
        listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for _, k, _ in base) for kind in range(4))
        assert {*filter(None, listed.split(","))} <= {*filter(None, r.spans.split(","))}
    assert find_personal_data(make_docs([])).count() == 0


def test_redaction(make_docs):
    docs = make_docs([(1, "to a.b@c.de, 1.2.3.4!", "s"), (None, None, "s"), (2, "clean text", None), (2, "clean text", None)])
    got = redact(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = sorted([(r.doc_id, r.text, r.n_chars) for r in got.collect()], key=str)
    assert rows == sorted([(1, "to <email>, <ip>!", 17), (None, None, None), (2, "clean text", 10), (2, "clean text", 10)], key=str)
    assert redact(make_docs([])).count() == 0
