import os
import random

import pytest

from lontar.llm import tokens as K

pytestmark = pytest.mark.skipif(not os.path.exists(K.VOCABULARY), reason="no vocabulary")
PIECES = ["a", "b", " ", "  ", "\n", "1", "9", "!", "'s", "'", "é", "漢", "​", "😀", "\t", "<|endoftext|>", "ll", "'ll", ".", " "]


@pytest.mark.parametrize("window", [1, 4, 256])
def test_tree_equals_whole(monkeypatch, window):
    monkeypatch.setattr(K, "WINDOW", window)
    coder, rnd = K.encoding(K.VOCABULARY), random.Random(window)
    for _ in range(1500):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 120)))
        assert K.encode(text, coder, rnd.choice([1, 2, 3, 5, 9])) == coder.encode_ordinary(text)


def test_long_run_without_borders():
    coder = K.encoding(K.VOCABULARY)
    for text in ("x" * 5000, " " * 5000, "ab " * 3000):
        assert K.encode(text, coder, 100) == coder.encode_ordinary(text)
        assert K.decode(K.encode(text, coder, 100), coder) == text


def test_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "Pasal 1\n", "k"), (3, "Pasal 1\n", "k"), (None, "<|endoftext|>", "k")]
    d = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r.key, r.ids) for r in K.token_ids(d, "doc_id", "text").collect()), key=str)
    coder = K.encoding(K.VOCABULARY)
    assert got == sorted([(1, []), (2, []), (3, coder.encode_ordinary("Pasal 1\n")), (3, coder.encode_ordinary("Pasal 1\n")), (None, coder.encode_ordinary("<|endoftext|>"))], key=str)
    assert max(K.token_counts(d, "doc_id", "text").toPandas()["n_tokens"]) > 1
    assert K.token_ids(d.limit(0), "doc_id", "text").count() == 0


def test_ordinary_texts_go_through_the_tree():
    """Production leaf and window: joins up the tree give the ids of the whole text."""
    coder, rnd = K.encoding(K.VOCABULARY), random.Random(9)
    words = ["Pasal", " 12", "\n\n", " pihak", "  ", " don't", ".", " 漢字", "\t", " the", " é"]
    for _ in range(60):
        text = "".join(rnd.choice(words) for _ in range(rnd.randint(600, 3000)))
        assert len(text) > K.LEAF and K.encode(text, coder) == coder.encode_ordinary(text)
