import random

import numpy as np
import pyarrow as pa
from llm.helpers import words

from endpulse.llm import words as lib

TEXTS = ["", None, "One, two;three", "ÉTÉ été x", "a" * 70, "...", "tail word", "Ünï-cödé 9z", "\n\nx\n", "ß" * 30 + " A1"]


def hashes_by_text(texts):
    hashes, owners, begins, ends = lib.word_hashes(*lib.text_bytes(pa.array(texts, pa.string())))
    return [hashes[owners == i].tolist() for i in range(len(texts))]


def test_words_are_those_of_the_pattern_and_equal_words_have_equal_hashes():
    found = hashes_by_text(TEXTS)
    for text, own in zip(TEXTS, found):
        assert own == [lib.hash_word(w) for w in words(text)]


def test_texts_do_not_run_into_each_other():
    assert hashes_by_text(["ab", "cd"]) == [[lib.hash_word("ab")], [lib.hash_word("cd")]]
    assert hashes_by_text(["abcd"]) != hashes_by_text(["ab", "cd"])


def test_blocks_do_not_cut_words(monkeypatch):
    random.seed(3)
    texts = [" ".join("é" * random.randint(1, 9) for _ in range(random.randint(0, 40))) for _ in range(30)]
    whole = hashes_by_text(texts)
    monkeypatch.setattr(lib, "BLOCK", 17)
    lib._powers.clear()
    assert hashes_by_text(texts) == whole
    lib._powers.clear()


def test_sliced_arrays_and_parts_of_a_batch():
    column = pa.array(TEXTS, pa.string())
    hashes, owners, _, _ = lib.word_hashes(*lib.text_bytes(column.slice(2, 3)))
    assert [hashes[owners == i].tolist() for i in range(3)] == hashes_by_text(TEXTS)[2:5]
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    parts = list(lib.slices(batch, "text", 20))
    assert sum(p.num_rows for p in parts) == len(TEXTS) and len(parts) > 2
    assert [t for p in parts for t in p.column(0).to_pylist()] == TEXTS


def test_grams_depend_on_order_and_distance():
    h = np.array([1, 2, 1, 2, 2], dtype=np.uint64)
    pairs = lib.gram_hashes(h, (0, 1))
    assert len(pairs) == 4 and pairs[0] == pairs[2] != pairs[1]
    assert lib.gram_hashes(h, (0, 2))[0] != lib.gram_hashes(h, (0, 1))[3]
    assert len(lib.gram_hashes(h[:1], (0, 2))) == 0
