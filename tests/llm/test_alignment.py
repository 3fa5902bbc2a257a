import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from llm.helpers import rows_of, table
from tokenizers import Tokenizer

from endpulse.llm import alignment as lib
from endpulse.llm.queries import QUERIES, piece_tokenizer_path, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
A = Tokenizer.from_file(tokenizer_path())
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=piece_tokenizer_path())
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum", "groups_sha256"]


def alphabet():
    """The byte alphabet, rebuilt from single bytes: é and the like come out as two entries."""
    table = {}
    for b in range(256):
        if b < 128:
            ids, want = A.encode(chr(b), add_special_tokens=False).ids, [b]
        else:
            continue
        for i, x in zip(ids, want):
            table[A.id_to_token(i)] = x
    for lead in range(0x80, 0x800, 0x3F):
        text = chr(lead)
        tokens = "".join(A.id_to_token(i) for i in A.encode(text, add_special_tokens=False).ids)
        table.update(zip(tokens, text.encode()))
    return table


def bytes_of(text):
    """Whole text, not cut: [(id, bytes)] of both tokenizers, or None."""
    if not text:
        return None
    whole = " " + text
    encoded = A.encode(whole, add_special_tokens=False)
    known = lib.byte_alphabet()
    left = [(i, bytes(known[c] for c in A.id_to_token(i))) for i in encoded.ids]
    right = []
    for i in B.encode(text, num_threads=1):
        piece = B.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    want = whole.encode()
    return (left, right) if b"".join(b for _, b in left) == b"".join(b for _, b in right) == want else None


def spans(tokens):
    at, out = 0, []
    for i, b in tokens:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def by_hand(docs):
    """[(doc_id, text)]: the expected rows, link by link."""
    found, held = [], Counter()
    for doc_id, text in docs:
        both = bytes_of(text)
        if both is None:
            found.append((doc_id, None))
            continue
        a, b = map(spans, both)
        covers = [[i for i, s, e in side for _ in range(s, e)] for side in (a, b)]  # the id at each byte
        starts = [{s for _, s, _ in side} for side in (a, b)]
        places = [i for i in range(len(covers[0])) if i in starts[0] or i in starts[1]]
        links = [(covers[0][i], covers[1][i]) for i in places]  # a link begins where either token does
        groups = []
        for i in places:
            if i in starts[0] and i in starts[1]:
                groups.append(([], []))
            for side in (0, 1):
                if i in starts[side]:
                    groups[-1][side].append(covers[side][i])
        found.append((doc_id, (a, b, links, groups)))
        held.update(set(links))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for doc_id, x in found:
        if x is None:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = x
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append((doc_id, len(a), len(b), len(groups), len(links), sum(len(g) * len(h) for g, h in groups),
                     sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                     hashlib.sha256(text.encode()).hexdigest()))
    return sorted(rows, key=repr)


def test_byte_alphabet_is_the_tokenizers_own():
    known = lib.byte_alphabet()
    assert len(known) == 256 and sorted(known.values()) == list(range(256))
    assert {c: known[c] for c in alphabet()} == alphabet()


def dense(m):
    out = np.zeros((m.n_rows, m.n_columns), np.int64)
    np.add.at(out, (m.rows(), m.indices), m.data)
    return out


def test_row_products_are_matrix_products(monkeypatch):
    monkeypatch.setattr(lib, "TERMS", 7)
    rand = np.random.default_rng(4)
    for _ in range(100):
        n, k, m = rand.integers(1, 9, 3)
        full = [rand.integers(0, 3, shape) * (rand.random(shape) < 0.5) for shape in ((n, k), (k, m))]
        a, b = (lib.Csr(np.concatenate([[0], np.cumsum((x != 0).sum(axis=1))]), np.nonzero(x)[1], x[x != 0], x.shape[1])
                for x in full)
        assert (dense(lib.product(a, b)) == full[0] @ full[1]).all()
        assert (dense(lib.transposed(a)) == full[0].T).all()


def test_links_and_groups_of_random_cuts():
    rand = random.Random(5)
    for _ in range(200):
        n = rand.randint(1, 30)
        cuts = [sorted({*rand.sample(range(1, n), rand.randint(0, n - 1)), n}) if n > 1 else [n] for _ in range(2)]
        lengths = [np.diff([0, *c]) for c in cuts]
        found = lib.align(*lengths)
        starts = [[0, *c[:-1]] for c in cuts]
        want = {(i, j): min(e, f) - max(s, t) for i, (s, e) in enumerate(zip(starts[0], cuts[0]))
                for j, (t, f) in enumerate(zip(starts[1], cuts[1])) if min(e, f) > max(s, t)}
        got = dict(zip(zip(found.links.rows().tolist(), found.links.indices.tolist()), found.links.data.tolist()))
        assert got == want
        shared = {(i, j) for rows, columns, _ in found.shared() for i, j in zip(rows.tolist(), columns.tolist())}
        assert shared == {(i, j) for i, g in enumerate(found.groups_a) for j, h in enumerate(found.groups_b) if g == h}
        assert found.n_groups == len(set(cuts[0]) & set(cuts[1]))


def random_docs(n):
    rand = random.Random(6)
    letters = ["a", "the ", "Über", " x", "  ", "\n", "\n\n", ". ", "don't", "日本", "\U0001f600", "é", "é", "\t",
               "0123", "unbelievable", "<|endoftext|>", "<0x0A>", "</s>", " ", "\x00", " ."]
    texts = ["".join(rand.choice(letters) for _ in range(rand.randint(0, 30))) for _ in range(n)]
    texts[:8] = [None, "", " ", "\n", "▁", "a ▁ b", "same text here", "same text here"]
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk", [60, 1 << 21])
def test_against_whole_texts(spark, monkeypatch, chunk):
    docs = random_docs(300)
    docs += [(7, "same text here"), (None, "a null id"), (10**12, "=" * 3000 + " " + "日本" * 400)]
    monkeypatch.setattr(lib, "CHUNK", chunk)
    frame = table(spark, docs, extra=["pairs", "chunk", "n", "at", "pair", "n_a"]).repartition(3)
    got = rows_of(lib.aligned(frame, tokenizer_path(), piece_tokenizer_path()), *COLUMNS)
    assert got == by_hand(docs)


def long_docs():
    """Texts of many different words, some megabytes."""
    rand = random.Random(7)
    words = ["".join(rand.choices("abcdefghijklmnop", k=rand.randint(2, 9))) for _ in range(60_000)]
    return [(i, " ".join(rand.choices(words, k=n))) for i, n in enumerate([3, 60_000, 500, 150_000, 2_000, 150_000])]


def test_spark_moves_small_rows_only(spark):
    """A stored row is held several times by the JVM that reads, sorts and sends it."""
    chunks = lib.chunks_of(table(spark, long_docs()).coalesce(1), tokenizer_path(), piece_tokenizer_path())
    sizes = {"binary": "length(`{}`)", "array<int>": "4 * size(`{}`)", "array<bigint>": "8 * size(`{}`)"}
    total = " + ".join(f"coalesce({sizes[kind].format(c)}, 0)" for c, kind in chunks.dtypes if kind in sizes)
    most, whole = chunks.selectExpr(f"max({total})", f"sum({total})").first()
    assert most <= 256 << 10 < 1 << 20 < whole


def test_documents_stored_in_several_rows(spark):
    docs = [(1, "the same few words"), (2, None), *long_docs()[:2]]
    frame = table(spark, docs).coalesce(1)
    chunks = lib.chunks_of(frame, tokenizer_path(), piece_tokenizer_path())
    assert chunks.where("at < -1").count() > 0
    assert rows_of(lib.aligned(frame, tokenizer_path(), piece_tokenizer_path()), *COLUMNS) == by_hand(docs)


@pytest.mark.parametrize("n_rows", [1, 3, 100])
def test_chunks_are_gathered_from_their_rows(monkeypatch, n_rows):
    monkeypatch.setattr(lib, "PART", 100)
    monkeypatch.setattr(lib, "ROWS", 2)
    pair = lib.Pair(tokenizer_path(), piece_tokenizer_path())
    texts = [["some words", "of a text"], [None, ""], ["words again", None, "of another text"]]
    made = [lib._chunk(pair, pa.array(range(len(t))), t) for t in texts]
    stored = pa.Table.from_batches([b for i, x in enumerate(made) for b in lib._stored(i, *x)])
    assert stored.schema.names == [c.split()[0] for c in lib.STORED.split(", ")]
    assert len(set(zip(stored["chunk"].to_pylist(), stored["at"].to_pylist()))) == len(stored)
    rows = stored.select(["chunk", "at", "pair", "part"]).combine_chunks().to_batches(n_rows)
    got = list(lib._gathered([rows[0].slice(0, 0), *rows]))
    assert [d.to_pylist() for d, _ in got] == [x[2].to_pylist() for x in made]
    assert [v.tolist() for _, v in got] == [x[0].tolist() for x in made]
    assert not len(made[1][0]) and len(made[0][0]) > 2


def test_query_on_whole_documents(spark):
    frame = QUERIES["op11_alignment"](spark, SF_DIR)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(frame.columns) == sorted(COLUMNS)
    assert rows_of(frame, *COLUMNS) == by_hand(docs)


def test_empty_table_and_tables_without_tokens(spark):
    frame = table(spark, [(1, None), (2, ""), (3, "▁")])
    run = lambda f: rows_of(lib.aligned(f, tokenizer_path(), piece_tokenizer_path()), *COLUMNS)
    assert run(frame) == [(i, 0, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    assert run(frame.where("doc_id > 5")) == []


def test_links_themselves(spark):
    docs = random_docs(120)
    got = {r.doc_id: [tuple(x) for x in r.links] for r in lib.links(
        table(spark, docs), tokenizer_path(), piece_tokenizer_path()).collect()}
    for doc_id, text in docs:
        both = bytes_of(text)
        a, b = map(spans, both) if both else ([], [])
        assert got[doc_id] == [(x[0], y[0], max(x[1], y[1]), min(x[2], y[2]) - max(x[1], y[1]))
                               for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
