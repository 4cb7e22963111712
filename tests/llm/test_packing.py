import random
import zlib
from array import array

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from riverdeck.llm import packing
from riverdeck.llm.packing import END, VOCABULARY, WINDOW, best_fit_decreasing, pack, packing_report, word_ids

LIBRARY = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
LETTERS = [*"abc DE'sll  \n\t\x0b\r\x1c\x85\xa0　éÉßÑ漢字😀1²½!?<|>ΣİÅ", "<|endoftext|>", " the", "'re", "'S", "é"]


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [END]


def test_ids_equal_the_library():
    pick, ids = random.Random(2), word_ids(public_tokenizers.path(VOCABULARY)).ids
    for _ in range(3000):
        text = "".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 40)))
        assert array("I", ids(text)).tolist() + [END] == expected(text), repr(text)


def test_every_plain_character_equals_the_library():
    """Each character of the fast way: alone, between letters, beside digits, blanks, marks and itself."""
    ids, plain = word_ids(public_tokenizers.path(VOCABULARY)).ids, [c for c in map(chr, range(0x1000)) if packing.PLAIN.fullmatch(c)]
    assert len(plain) > 250
    for c in plain:
        for text in (c, f"ab{c}cd", f"1{c}2 {c}", f"Ab {c}, {c}{c}.", f"x'{c}'s"):
            assert array("I", ids(text)).tolist() + [END] == expected(text), repr(text)


def test_every_other_character_equals_the_library():
    """Characters where Unicode tables differ, and one of each stretch of 61 code points."""
    ids = word_ids(public_tokenizers.path(VOCABULARY)).ids
    for point in (0x558, 0x88F, 0xC5C, 0x1C89, 0x208F, 0xA7CB, 0x107BB, 0x10940, 0x10D50, 0x130, *range(0x131, 0x110000, 61)):
        if not 0xD800 <= point <= 0xDFFF:
            text = f"a {chr(point)} b{chr(point)}c 1{chr(point)}"
            assert array("I", ids(text)).tolist() + [END] == expected(text), hex(point)


def test_batches_are_bounded(make_docs, monkeypatch):
    rows = [(k, f"word{k} " * 50, "s") for k in range(200)] + [(200, "long " * 30_000, "s"), (201, None, "s")]
    whole = sorted(map(tuple, packing.pieces(make_docs(rows), with_ids=True).collect()))
    monkeypatch.setattr(packing, "BATCH_BYTES", 1)
    batch = packing._batch(pa.array([7, 8]), [0, 1, 1], [(0, b"\0" * 8, 2), (0, b"\1" * 4, 1), (1, b"", 1)], True)
    assert batch.column("ids").to_pylist() == [[0, 0], [0x01010101], []] and batch.column("doc_id").to_pylist() == [7, 8, 8]
    assert sorted(map(tuple, packing.pieces(make_docs(rows), with_ids=True).collect())) == whole


def test_best_fit_against_a_plain_search():
    pick = random.Random(1)
    for _ in range(200):
        window = pick.choice([8, 16, 31, 64])
        lengths = sorted([pick.randint(1, window) for _ in range(pick.randint(0, 60))], reverse=True)
        used = []
        for length in lengths:
            fits = [u for u in used if u + length <= window]
            if fits:
                used[used.index(max(fits))] += length
            else:
                used.append(length)
        filled = {}
        for length, (number, offset) in zip(lengths, best_fit_decreasing(lengths, window)):
            assert filled.get(number, 0) == offset
            filled[number] = offset + length
        assert sorted(filled.values()) == sorted(used)


def check(rows, texts):
    """Every id in one piece, sequences gapless and within the window."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, own in by_doc.items():
        ids, copies = expected(texts[doc_id][0]), texts[doc_id][1]
        assert sum(r.length for r in own) == len(ids) * copies
        for r in own:
            part = ids[r.start:r.start + r.length]
            assert len(part) == r.length and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(array("I", part).tobytes())
    assert by_doc.keys() == texts.keys()
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= WINDOW
    return sum(r.length for r in rows) / WINDOW / len(by_sequence)


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fill = check(packing_report(docs).collect(), {r.doc_id: (r.text, 1) for r in docs.collect()})
    assert fill > 0.97


def test_edges_and_shards(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    rows = [(1, None, "a"), (2, "", None), (3, "same text", "a"), (3, "same text", "a"), (None, "no id", "a"),
            (4, "word " * 9000, "b"), *[(k, "w " * (k * 13 % 900), "c") for k in range(10, 130)]]
    texts = {k: (t, 2 if k == 3 else 1) for k, t, _ in rows}
    check(packing_report(make_docs(rows)).collect(), texts)
    with_ids = pack(make_docs(rows), with_ids=True).collect()
    assert all(zlib.crc32(array("I", r.ids).tobytes()) == r.ids_crc32 for r in with_ids)
    assert pack(make_docs([])).count() == 0
