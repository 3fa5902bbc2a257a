"""Packing examples into sequences: vector bin packing by the dot-product heuristic.

An example has token ids (those of its prompt, its text and an end id) and needs
three resources of a sequence at once: tokens, one segment, and loss-bearing tokens
(all behind the prompt). A sequence is filled from a window of waiting examples: the
one whose demand has the largest dot product with what is left of the sequence, both
as shares of the limits, goes in next, as long as any fits. If none does, the best one
is cut to fill the rest. A sequence that is not full when it must be closed (no
segments or no loss left, or nothing waits) is cut to a power of two, which needs no
padding, and the rest waits on. With ``whole`` only examples that no empty sequence
can hold are cut, and sequences may need padding.

Each task packs its own rows and holds WINDOW waiting pieces of at most one
sequence, so memory does not grow with the input and nothing is shuffled; only its
last few sequences are short ones.

Defined results: a null text or prompt is empty (an empty example is its end id
alone); rows with null or repeated doc_ids are packed like others; an empty table
gives no rows; a very long text is encoded in parts; columns other than doc_id, text
and prompt are ignored. Equal products go to the example that waits longest.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from endpulse.llm.common import write_table
from endpulse.llm.pieces import Letters, in_worker, long_parts, marked
from endpulse.llm.words import slices

END_ID = 1
WINDOW = 512
KEPT_WORDS, KEPT_CHARS = 300_000, 8 << 20
LONG = 4 << 20  # characters of one text encoded at once


@dataclass(frozen=True)
class Limits:
    """What a sequence can hold."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits must be positive")


class WordIds(dict):
    """Ids of texts under a tokenizer that drops white space; each distinct word is encoded once.

    Words are kept in two generations: when the newer one is full it becomes the older one, whose words come
    back when they are met again and go with it otherwise.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Letters(self.tokenizer, lower=True)
        self.older, self.chars = {}, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            # Marks behind a letter are tokens of their own, and case does not count, so fewer words are encoded.
            stem, marks = marked(word)
            plain = self.letters.right and self.letters.fits(stem)
            if marks:
                ids = self[stem.lower() if plain else stem] + self[marks]
            elif plain:
                ids = array("I", self.letters(word)).tobytes()
            else:
                ids = self.encoded(word)
        self[word] = ids
        self.chars += len(word)
        return ids

    def encoded(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def many(self, texts: list[str]) -> list[bytes]:
        if len(self) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.older, self.chars = dict(self), 0
            self.clear()
        ids = self.__getitem__
        return [b"".join(map(ids, t.replace("\n", " ").split(" "))) for t in texts]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = self.many([t if len(t) <= LONG else "" for t in texts])
        for i, text in enumerate(texts):
            if len(text) > LONG:
                out[i] = b"".join(chain.from_iterable(self.many([part]) for part in long_parts(text, LONG)))
        return out


@dataclass(slots=True)
class Piece:
    """A waiting part of an example: ids[start:end], of which those from loss_from on bear loss."""

    doc: object
    ids: np.ndarray
    start: int
    end: int
    loss_from: int

    def loss(self) -> int:
        return max(0, self.end - max(self.start, self.loss_from))

    def longest(self, tokens: int, loss: int) -> int:
        """How many of its first ids take no more than these."""
        return min(tokens, self.end - self.start, max(self.start, self.loss_from) + loss - self.start)


class Packer:
    """Fills sequences from a window of waiting pieces; yields lists of pieces."""

    def __init__(self, limits: Limits, whole: bool = False, window: int = WINDOW):
        self.limits, self.whole, self.window = limits, whole, window
        self.waiting: list[Piece] = []
        # Demands of the waiting pieces as shares of the limits, and in tokens.
        self.tokens, self.losses = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, piece: Piece):
        """Take an example; yields the sequences that are full with it."""
        limits = self.limits
        while piece.end > piece.start:
            n = piece.longest(limits.tokens, limits.loss)
            if n == piece.end - piece.start:
                self._wait(piece)
                break
            head = Piece(piece.doc, piece.ids, piece.start, piece.start + n, piece.loss_from)
            piece = Piece(piece.doc, piece.ids, piece.start + n, piece.end, piece.loss_from)
            if n == limits.tokens:
                yield [head]
            else:
                self._wait(head)
        while len(self.waiting) > self.window:
            yield self._fill()

    def rest(self):
        while self.waiting:
            yield self._fill()

    def _wait(self, piece: Piece) -> None:
        # Waiting pieces do not hold the ids of a long example that is packed already.
        if len(piece.ids) > piece.end - piece.start:
            piece = Piece(piece.doc, Part(piece.ids, piece.start, piece.end), piece.start, piece.end, piece.loss_from)
        self.waiting.append(piece)
        self.tokens = np.append(self.tokens, piece.end - piece.start)
        self.losses = np.append(self.losses, piece.loss())

    def _take(self, at: list[int]) -> None:
        gone = set(at)
        self.waiting = [p for i, p in enumerate(self.waiting) if i not in gone]
        self.tokens, self.losses = np.delete(self.tokens, at), np.delete(self.losses, at)

    def _fill(self) -> list[Piece]:
        limits = self.limits
        tokens, segments, loss = limits.tokens, limits.segments, limits.loss
        free = np.ones(len(self.waiting), bool)
        chosen, inside = [], []

        def best(candidates: np.ndarray) -> int:
            products = (self.tokens * (tokens / limits.tokens ** 2) + segments / limits.segments ** 2
                        + self.losses * (loss / limits.loss ** 2))
            return int(np.argmax(np.where(candidates, products, -1.0)))

        while tokens and segments:
            fits = free & (self.tokens <= tokens) & (self.losses <= loss)
            if not fits.any():
                break
            i = best(fits)
            chosen.append(i)
            inside.append(self.waiting[i])
            free[i] = False
            tokens, segments, loss = tokens - self.tokens[i], segments - 1, loss - self.losses[i]
        back = []
        if not self.whole:
            if tokens and segments and free.any():
                i = best(free)
                piece = self.waiting[i]
                n = piece.longest(int(tokens), int(loss))
                if n > 0:
                    chosen.append(i)
                    inside.append(Piece(piece.doc, piece.ids, piece.start, piece.start + n, piece.loss_from))
                    back.append(Piece(piece.doc, piece.ids, piece.start + n, piece.end, piece.loss_from))
                    tokens -= n
            used = limits.tokens - int(tokens)
            if tokens and used & (used - 1):
                surplus = used - (1 << (used.bit_length() - 1))
                while surplus:  # the last pieces wait on, the one at the border in part
                    last = inside.pop()
                    n = min(surplus, last.end - last.start)
                    surplus -= n
                    back.append(Piece(last.doc, last.ids, last.end - n, last.end, last.loss_from))
                    if last.end - last.start > n:
                        inside.append(Piece(last.doc, last.ids, last.start, last.end - n, last.loss_from))
        self._take(chosen)
        for piece in joined(back):
            self._wait(piece)
        return inside


class Part:
    """ids[start:end] of an example, addressed by their places in the example."""

    def __init__(self, ids, start: int, end: int):
        self.own, self.start = np.array(ids[start:end]), start

    def __len__(self) -> int:
        return len(self.own)

    def __getitem__(self, span: slice) -> np.ndarray:
        return self.own[span.start - self.start:span.stop - self.start]


def joined(pieces: list[Piece]) -> list[Piece]:
    """Pieces of one example that follow one another become one again, if they hold the same ids."""
    out: list[Piece] = []
    for piece in sorted(pieces, key=lambda p: p.start):
        for i, other in enumerate(out):
            if other.ids is piece.ids and other.end == piece.start:
                out[i] = Piece(piece.doc, piece.ids, other.start, piece.end, piece.loss_from)
                break
        else:
            out.append(piece)
    return out


PACKED = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, n_loss bigint, "
          "part int, number bigint, offset bigint")


def packed(examples: DataFrame, tokenizer: str, limits: Limits = Limits(), whole: bool = False,
           with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, n_loss, sequence_id, offset, stored.

    examples have doc_id, text and perhaps prompt, whose ids bear no loss. With ``with_ids`` the pieces
    come with their ids (column ids), which ``sequences`` puts together.
    """
    prompt = F.coalesce("prompt", F.lit("")) if "prompt" in examples.columns else F.lit("")
    rows = examples.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), prompt.alias("prompt"))

    def table(pieces, part, number):
        columns = [[] for _ in range(10)]
        for sequence in pieces:
            offset = 0
            for p in sequence:
                ids = np.ascontiguousarray(p.ids[p.start:p.end], "<u4")
                row = (p.doc[0], p.start, len(ids), zlib.crc32(ids), p.doc[1], p.loss(), part, number, offset,
                       ids.astype(np.int32))
                for column, value in zip(columns, row):
                    column.append(value)
                offset += len(ids)
            number += 1
        kinds = [pa.int64()] * 6 + [pa.int32(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "n_loss", "part", "number", "offset"]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        if with_ids:
            arrays, names = [*arrays, pa.array(columns[9], pa.list_(pa.int32()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(arrays, names=names), number

    def pack(batches):
        encode, packer, number = None, Packer(limits, whole), 0
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for rows in slices(batch, "text"):
                encode = encode or in_worker(f"words {tokenizer}", lambda: WordIds(tokenizer))
                prompts, texts = encode(rows.column(2).to_pylist()), encode(rows.column(1).to_pylist())
                ready = []
                for doc_id, before, ids in zip(rows.column(0).to_pylist(), prompts, texts):
                    whole_ids = np.frombuffer(before + ids + end, "<u4")
                    ready += packer.add(Piece((doc_id, len(whole_ids)), whole_ids, 0, len(whole_ids), len(before) // 4))
                out, number = table(ready, part, number)
                yield out
        out, number = table(packer.rest(), part, number)
        yield out

    kind = PACKED + (", ids array<int>" if with_ids else "")
    pieces = write_table(rows.mapInArrow(pack, kind), "packed")
    counts = pieces.groupBy("part").agg((F.max("number") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    bases = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return pieces.join(F.broadcast(bases), "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "n_loss",
        (F.col("base") + F.col("number")).alias("sequence_id"), "offset", *(["ids"] if with_ids else []))


def sequences(pieces: DataFrame, limits: Limits = Limits(), pad_id: int = 0) -> DataFrame:
    """Per sequence: its ids padded as far as needed, segment numbers (0: padding) and loss mask.

    pieces are those of ``packed(..., with_ids=True)``; a sequence has at most limits.tokens ids.
    """
    pieces = pieces.withColumn("loss", F.transform(
        "ids", lambda x, i: (i >= F.col("length") - F.col("n_loss")).cast("int")))
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "loss")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("p"))
    used = F.aggregate("p", F.lit(0), lambda n, x: n + F.size(x["ids"]))
    rows = rows.withColumn("used", used).withColumn("padding", F.when(
        F.col("used").bitwiseAND(F.col("used") - 1) == 0, 0).otherwise(limits.tokens - F.col("used")))
    fill = lambda value: F.array_repeat(F.lit(value), F.col("padding"))
    return rows.select(
        "sequence_id", F.concat(F.flatten(F.transform("p", lambda x: x["ids"])), fill(pad_id)).alias("ids"),
        F.concat(F.flatten(F.transform("p", lambda x, i: F.array_repeat(i + 1, F.size(x["ids"])))), fill(0)).alias("segments"),
        F.concat(F.flatten(F.transform("p", lambda x: x["loss"])), fill(0)).alias("loss_mask"),
        "padding")
