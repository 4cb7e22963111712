import random

import public_tokenizers
from tokenizers import Tokenizer

from riverdeck.llm.token_counts import VOCABULARY, count_tokens, merger

LIBRARY = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
LETTERS = [*"abc de'sll  \n\t\x0b\r\x1c\x85\xa0　éßñ漢字😀1²½!?<|>", "<|endoftext|>", " the", "'re", "   ", "\n\n"]


def expected(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library():
    pick = random.Random(2)
    count = merger(public_tokenizers.path(VOCABULARY)).count
    for _ in range(3000):
        text = "".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 40)))
        assert count(text) == expected(text), repr(text)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        n = expected(r.text or "")
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 1024)


def test_edges(make_docs):
    long = "ab" * 60_000 + " x" * 600_000
    rows = [(1, None, "a"), (2, "", None), (3, "twice", "a"), (3, "twice", "a"), (None, long, "a")]
    got = sorted([tuple(r) for r in count_tokens(make_docs(rows)).collect()], key=str)
    one = expected("twice")
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (3, 5, one, False), (3, 5, one, False),
                          (None, len(long), expected(long), True)], key=str)
    assert count_tokens(make_docs([])).count() == 0
