import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
from llm.helpers import rows_of, table
from tokenizers import Tokenizer

from endpulse.llm import token_files as lib
from endpulse.llm.queries import tokenizer_path

WHOLE = Tokenizer.from_file(tokenizer_path())
ENCODER = lib.Encoder(tokenizer_path())


def ids_of(text):
    return np.array(WHOLE.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def shard(docs):
    out = Memory()
    writer = lib.ShardWriter(out)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    return out, writer.close()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(list("aB'sll 0\t\n\r,.é\u00a0\u2003\x1c\u0085<|>") + [
    "  ", " \n", "<|endoftext|>", "don't", " the"]), max_size=30).map("".join))
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert ENCODER(text) == ids_of(text)


def test_pieces_are_forgotten_when_there_are_many(monkeypatch):
    monkeypatch.setattr(lib, "KEPT_PIECES", 5)
    encode = lib.Encoder(tokenizer_path())
    for text in ["a b c d e f g h", "i j k", "a b c", "z"]:
        assert encode(text) == ids_of(text)


def test_many_and_long_texts(monkeypatch):
    """Blocks, texts that are cut in parts, and pieces learned in one block and met in the next."""
    monkeypatch.setattr(lib, "BLOCK", 50)
    rand = random.Random(7)
    word = lambda: "".join(rand.choice("abé,.'9ß") for _ in range(rand.randint(1, 6)))
    texts = [rand.choice([" ", "\n", " ", "  "]).join(word() for _ in range(rand.choice([0, 1, 5, 30, 200]))) for _ in range(200)]
    texts[3] = None
    encode = lib.Encoder(tokenizer_path())
    column = pa.array(texts, pa.string()).fill_null("")
    assert list(encode.texts(column)) == [ids_of(t) for t in texts]


def test_shard_round_trip_and_random_access(monkeypatch):
    monkeypatch.setattr(lib, "FRAME_IDS", 50)
    rand = random.Random(1)
    docs = [(rand.choice([i, None]), rand.randbytes(4 * rand.choice([0, 1, 7, 49, 50, 51, 400]))) for i in range(60)]
    out, counts = shard(docs)
    assert counts == (60, sum(len(b) for _, b in docs) // 4)
    reader = lib.ShardReader(out)
    for i in rand.sample(range(60), 60):
        assert b"".join(reader.parts(i)) == docs[i][1]
        assert (None if reader.none[i] else reader.ids[i]) == docs[i][0]
    # Any zstandard reader skips the index and the seek table.
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(b for _, b in docs)


def test_only_the_frames_of_a_document_are_read(monkeypatch):
    monkeypatch.setattr(lib, "FRAME_IDS", 50)
    out, _ = shard([(i, bytes(4 * 50)) for i in range(40)])
    reader, seen = lib.ShardReader(out), []
    monkeypatch.setattr(reader, "frame", lambda n, old=reader.frame: (seen.append(n), old(n))[1])
    assert len(b"".join(reader.parts(17))) == 200 and seen == [17]


def test_damage_is_found():
    out, _ = shard([(1, random.Random(2).randbytes(4000))])
    raw = bytearray(out.getvalue())
    raw[200] ^= 1
    with pytest.raises(Exception):
        b"".join(lib.ShardReader(Memory(bytes(raw))).parts(0))
    with pytest.raises(ValueError):
        lib.ShardReader(Memory(b"x" * 50))


def test_query_columns(spark):
    rand = random.Random(3)
    docs = [(i, " ".join(rand.choice(["the", "x", "Öl,", "9"]) for _ in range(rand.randint(0, 60)))) for i in range(80)]
    docs += [(100, None), (101, ""), (None, "first"), (102, "long one " * 30_000), (103, "<|endoftext|> a  b"), (7, "x"), (7, "x")]
    rand.shuffle(docs)
    frame = table(spark, docs, ["start", "shard", "file", "n_tokens"])
    rows = lib.read_documents(lib.write_shards(frame, tokenizer_path())).collect()
    want = []
    for doc_id, text in docs:
        ids = ids_of(text) + bytes(4)
        want.append((doc_id, len(ids) // 4, zlib.crc32(ids)))
    assert rows_of(spark.createDataFrame(rows), "doc_id", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    rows.sort(key=lambda r: r["start"])
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert order == sorted(order)
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]


def test_empty_table(spark):
    none = table(spark, [(1, "a")]).where("false")
    assert lib.read_documents(lib.write_shards(none, tokenizer_path())).count() == 0


def thue_morse(n):
    """Two words of n letters that a polynomial hash modulo 2**64 takes for one from 1,024 letters on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_of_one_hash_have_their_own_ids(spark, n):
    one, other = thue_morse(n)
    encode = lib.Encoder(tokenizer_path())
    assert list(encode.texts(pa.array([one, f"x {other}", other, f"x {one}"]))) == [
        ids_of(t) for t in (one, f"x {other}", other, f"x {one}")]
    assert encode(other) == ids_of(other)  # in a later batch
    docs = [(1, f"x {one}"), (2, f"x {other}"), (3, f"y\n{other} {one}")]
    got = rows_of(lib.read_documents(lib.write_shards(table(spark, docs), tokenizer_path())), "doc_id", "n_tokens", "ids_crc32")
    assert got == [(i, len(ids_of(t)) // 4 + 1, zlib.crc32(ids_of(t) + bytes(4))) for i, t in docs]


def test_random_binary_words():
    rand = random.Random(9)
    words = ["".join(rand.choice("ab") for _ in range(rand.choice([1, 3, 8, 64, 700]))) for _ in range(800)]
    texts = [" ".join(rand.sample(words, 5)) for _ in range(300)]
    encode = lib.Encoder(tokenizer_path())
    assert list(encode.texts(pa.array(texts))) == [ids_of(t) for t in texts]


def test_words_behind_a_blank_need_the_model_only(monkeypatch):
    """They have the ids of the whole tokenizer, which is asked for the other pieces alone."""
    encode, asked = lib.Encoder(tokenizer_path()), []
    text = "First unbelievable words, Zürich ÉCOLE 12 x1 don't ǆ ж\nline İstanbul end. ſ ½ ª"
    whole = encode.tokenizer.encode(text, add_special_tokens=False).ids
    real = encode._together
    monkeypatch.setattr(encode, "_together", lambda pieces: asked.extend(pieces) or real(pieces))
    assert np.frombuffer(encode(text), "<u4").tolist() == whole
    assert {" 12", " x1", " don't", " ж"} <= set(asked)
    assert not {" unbelievable", " words", " Zürich", " ÉCOLE"} & set(asked)
