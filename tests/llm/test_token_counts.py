import random

import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from caselake.llm.token_counts import Counting, count_tokens, frequent_words, tokenizer_path

TEXTS = [None, "", " ", "a", "<|endoftext|>", "x <|endoftext|><|endoftext|> y", "it's  we'll\n\n\t z", "é ß 漢字 12,5 ½", "w" * 5000, "\x1c\x1d  a\xa0b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_random_strings(library):
    rng, own = random.Random(3), Counting(tokenizer_path(), ["the", "and,"])
    alphabet = "abcXYZ '\n\t\x1c\x85\xa0　​019.,!<|>éßñ漢😀"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert own.counts(texts) == expected
    assert own.counts(texts) == expected  # from the caches


def test_columns_and_edge_cases(spark, library):
    rows = [Row(doc_id=i, text=t, n_tokens="clash", key=1) for i, t in enumerate(TEXTS + TEXTS)]
    docs = spark.createDataFrame(rows)
    got = {r.doc_id: r for r in count_tokens(docs).collect()}
    for r in rows:
        text = r.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len(text.encode()), n, n > 1024)
    assert count_tokens(docs.limit(0)).count() == 0


def test_the_table_is_bounded(spark):
    docs = spark.createDataFrame([Row(text=" ".join(f"w{i % 50}" for i in range(200)))])
    assert len(frequent_words(docs, most=7)) == 7
