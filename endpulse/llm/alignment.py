"""Aligning the tokens of two tokenizers by the bytes they cover, with sparse matrices in CSR.

Both tokenizers cover the same bytes, a blank and the text. Each has an incidence
matrix, tokens by bytes, A and B; the row products of A Bᵀ (Gustavson: the rows of Bᵀ
that a row of A names are added up) are the bytes that a token of A and one of B share,
so its entries are the links. Offsets where tokens of both end cut the tokens into
groups; the product of the two group incidences, tokens by groups, links all tokens
that share a group.

Texts are cut where tokens of both end anyway (see ``pieces``), and the products of all
new pieces of some texts are computed together, as blocks of one matrix. Texts
are taken in chunks of about CHUNK bytes. A chunk's documents are stored as lists of pieces
and its pieces as lists of id pairs, compressed and in rows of at most PART bytes (Spark holds
several copies of a row that it moves); a row for each distinct pair has in how many of its
documents the pair stands. A chunk's distinct pairs are shuffled, added up over the corpus, and
sent back to the chunks that hold them; as a chunk holds a pair once, no pair is hot.

Defined results: texts that are null, empty, or whose joined token bytes differ from
blank and text have no tokens (zeros, groups_sha256 ''); rows with null or repeated
doc_ids count and are returned like others; an empty table gives no rows; columns other
than doc_id and text are ignored. A very long text is a chunk of its own; it is cut
in pieces like others, so only a single word of many megabytes needs more memory.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from endpulse.llm.common import write_table
from endpulse.llm.pieces import Known, Letters, byte_alphabet, in_worker, literal, marked, no_gc, spaced
from endpulse.llm.words import freeing, slices

CHUNK = 2 << 20
PART = 256 << 10
ROWS = 1 << 16  # of pairs, in a batch
SIDE = 1 << 24  # more ids than a tokenizer has; a pair is one number
TERMS = 1 << 18  # products expanded at once


@dataclass
class Csr:
    """A sparse matrix of whole numbers by rows; columns ascend in a row."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    n_columns: int

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.n_rows), np.diff(self.indptr))


def spans(lengths: np.ndarray) -> Csr:
    """Incidence of tokens that follow one another with what they cover: row i has lengths[i] ones."""
    indptr = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return Csr(indptr, np.arange(indptr[-1]), np.ones(indptr[-1], np.int64), int(indptr[-1]))


def membership(column: np.ndarray, n_columns: int) -> Csr:
    """Incidence with one entry in each row."""
    return Csr(np.arange(len(column) + 1), column.astype(np.int64), np.ones(len(column), np.int64), n_columns)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.indices, kind="stable")
    indptr = np.concatenate([[0], np.cumsum(np.bincount(m.indices, minlength=m.n_columns))]).astype(np.int64)
    return Csr(indptr, m.rows()[order], m.data[order], m.n_rows)


def row_products(a: Csr, b: Csr):
    """Row blocks of a·b, as (rows, columns, values) by row and column: Gustavson's row products.

    Each entry (i, k) of a adds its multiple of b's row k to row i; a block of rows is
    expanded to about TERMS such terms, and terms of one place are added up.
    """
    sizes = np.diff(b.indptr)[a.indices]  # terms of each entry of a
    before = np.concatenate([[0], np.cumsum(sizes)])
    row = 0
    while row < a.n_rows:
        end = int(np.searchsorted(before[a.indptr], before[a.indptr[row]] + TERMS, side="right")) - 1
        end = min(a.n_rows, max(row + 1, end))
        entries = slice(a.indptr[row], a.indptr[end])
        n = sizes[entries]
        total = int(n.sum())
        owner = np.repeat(np.arange(row, end), np.diff(before[a.indptr[row:end + 1]]))
        at = np.repeat(b.indptr[a.indices[entries]] - np.cumsum(n) + n, n) + np.arange(total)
        key = owner * b.n_columns + b.indices[at]
        terms = np.repeat(a.data[entries], n) * b.data[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, np.int64)
        values = np.add.reduceat(terms[order], first) if total else np.zeros(0, np.int64)
        yield key[first] // b.n_columns, key[first] % b.n_columns, values
        row = end


def product(a: Csr, b: Csr) -> Csr:
    blocks = list(row_products(a, b))
    rows, columns, values = (np.concatenate([x[i] for x in blocks]) if blocks else np.zeros(0, np.int64)
                             for i in range(3))
    indptr = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=a.n_rows))]).astype(np.int64)
    return Csr(indptr, columns, values, b.n_columns)


@dataclass
class Aligned:
    """Tokens of two tokenizers over the same bytes: links, and the group of each token."""

    links: Csr  # tokens of A by tokens of B: shared bytes
    groups_a: np.ndarray
    groups_b: np.ndarray
    n_groups: int

    def shared(self):
        """Row blocks of the group product: tokens by tokens that share a group."""
        return row_products(membership(self.groups_a, self.n_groups), transposed(membership(self.groups_b, self.n_groups)))


def align(lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """Align two tokenizations of the same bytes, given the bytes of each token; none is empty."""
    links = product(spans(lengths_a), transposed(spans(lengths_b)))
    ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
    ends = ends_b[ends_a[np.minimum(np.searchsorted(ends_a, ends_b), len(ends_a) - 1)] == ends_b]
    return Aligned(links, np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b), len(ends))


class Pair:
    """Two tokenizers, and what is known of each piece of text."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        size = self.a.get_vocab_size(with_added_tokens=True)
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else b"" for t in entries]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.n_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.n_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # Cuts before blanks are safe if no piece has a blank behind another character, or holds a line end.
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.cuts = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.names_a, self.names_b = (np.array([str(i) for i in range(n)], object) for n in (size, len(pieces)))
        self.letters, self.marks = Letters(self.a, head=" "), {}
        self.known = Known(self._learn)

    def _ids_b(self, literals: list[str]) -> list[list[int]]:
        """Ids of pieces; the tokenizer puts a blank before each, which some have themselves."""
        own = [p[:1] == " " for p in literals]
        found = self.b.encode([p[1:] if o else p for p, o in zip(literals, own)], num_threads=1)
        # Before a line end the blank is a token of its own.
        return [ids if o else ids[1:] for ids, o in zip(found, own)]

    def join_a(self, ids) -> bytes:
        return b"".join(map(self.bytes_a.__getitem__, ids))

    def join_b(self, ids) -> bytes:
        return b"".join(map(self.bytes_b.__getitem__, ids))

    def ids(self, literals: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        out, rest = [], []
        for i, p in enumerate(literals):
            stem, marks = marked(p[1:])
            if self.letters.right and p[0] == " " and self.letters.fits(stem):
                out.append(self.letters(stem) + (self._marks(marks) if marks else []))
            else:
                out.append(None)
                rest.append(i)
        for i, f in zip(rest, self.a.encode_batch_fast([literals[i] for i in rest], add_special_tokens=False)):
            out[i] = f.ids
        return out, self._ids_b(literals)

    def _marks(self, marks: str) -> list[int]:
        if marks not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[marks] = self.a.encode(marks, add_special_tokens=False).ids
        return self.marks[marks]

    def _learn(self, keys: list[str]) -> list[tuple | None]:
        """What each piece has, see ``_pieces``; None where the joined bytes of a tokenizer are not the piece."""
        out: list[tuple | None] = []
        for start in range(0, len(keys), 20_000):
            literals = [literal(k) for k in keys[start:start + 20_000]]
            all_a, all_b = self.ids(literals)
            give_back = lambda text, a, b: self.join_a(a) == text == self.join_b(b)
            if give_back("".join(literals).encode(), chain.from_iterable(all_a), chain.from_iterable(all_b)):
                out += self._pieces(all_a, all_b)
                continue
            good = [give_back(p.encode(), a, b) for p, a, b in zip(literals, all_a, all_b)]
            found = iter(self._pieces([a for a, ok in zip(all_a, good) if ok], [b for b, ok in zip(all_b, good) if ok]))
            out += [next(found) if ok else None for ok in good]
        return out

    def _pieces(self, all_a: list[list[int]], all_b: list[list[int]]):
        """Per piece: its groups as text, its counts (A, B, groups, links, shared links), and the pair of each link,
        the last two as bytes of 64-bit numbers.

        The tokens of all pieces, one behind the other, are two tokenizations of all their bytes.
        """
        if not all_a:
            return []
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (all_a, all_b))
        found = align(self.n_a[ids_a], self.n_b[ids_b])
        in_a, in_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (all_a, all_b))
        ends_a, ends_b = np.cumsum(in_a), np.cumsum(in_b)
        pairs = (ids_a[found.links.rows()] * SIDE + ids_b[found.links.indices]).tobytes()
        link_ends = found.links.indptr[ends_a]
        shared = np.zeros(len(ids_a) + 1, np.int64)
        for rows, _, _ in found.shared():
            shared[1:] += np.bincount(rows, minlength=len(ids_a))
        sizes = np.stack([in_a, in_b, np.diff(found.groups_a[ends_a - 1] + 1, prepend=0),
                          np.diff(link_ends, prepend=0), np.diff(np.cumsum(shared)[ends_a], prepend=0)], axis=1)
        # A group's A tokens, then its B tokens; each is followed by what stands behind it in the text.
        n_a, n_b = (np.bincount(g, minlength=found.n_groups) for g in (found.groups_a, found.groups_b))
        before_a, before_b = np.cumsum(n_b) - n_b, np.cumsum(n_a)
        parts = np.empty(2 * (len(ids_a) + len(ids_b)), object)
        parts[1::2] = ","
        for ids, groups, before, names in ((ids_a, found.groups_a, before_a, self.names_a),
                                           (ids_b, found.groups_b, before_b, self.names_b)):
            parts[2 * (np.arange(len(ids)) + before[groups])] = names[ids]
        parts[2 * (np.cumsum(n_a) + before_a) - 1] = "|"
        parts[2 * (np.cumsum(n_a) + np.cumsum(n_b)) - 1] = ";"
        parts[2 * (ends_a + ends_b) - 1] = "\n"
        texts = "".join(parts.tolist()).encode().split(b"\n")
        edges = [0, *(8 * link_ends).tolist()]
        counts, one = sizes.tobytes(), {}  # many pieces have the same counts: one object for all
        counts = [one.setdefault(c, c) for c in (counts[n:n + 40] for n in range(0, len(counts), 40))]
        return [(text, n, pairs[a:b]) for text, n, a, b in zip(texts, counts, edges, edges[1:])]

    def keys(self, text: str | None) -> list[str]:
        """Keys of the pieces of blank and text."""
        if not text:
            return []
        return spaced(" " + text) if self.cuts else ["\0=" + " " + text]


#: Rows of a chunk: parts of its documents (at -n to -1), then its pairs (at 0 on) and the documents that hold each.
STORED = "chunk bigint, at int, pair bigint, held int, part binary"
KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
DOCS = ("piece_ends", "piece_pairs", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256",
        "doc_ends", "doc_pieces")
ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")


def _chunk(pair: Pair, doc_ids: pa.Array, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
    """Pairs, in how many documents each stands, and in one row documents as lists of pieces, pieces as lists of pairs."""
    keys = [pair.keys(t) for t in texts]
    value = pair.known.meet(keys)
    local = dict.fromkeys(chain.from_iterable(keys))
    pieces = [*map(value, local)]
    # A text with a piece that its tokens do not give back has no tokens.
    if None in pieces:
        bad = {k for k, p in zip(local, pieces) if p is None}
        keys = [k if bad.isdisjoint(k) else [] for k in keys]
        local = dict.fromkeys(chain.from_iterable(keys))
        pieces = [*map(value, local)]
    of_groups, counts, codes = zip(*pieces) if pieces else ((), (), ())
    groups = dict(zip(local, of_groups)).__getitem__
    local = dict(zip(local, range(len(local))))
    lengths = np.array([len(k) for k in keys], np.int64)
    doc_ends = np.cumsum(lengths)
    doc_pieces = np.fromiter(map(local.__getitem__, chain.from_iterable(keys)), np.int64, int(lengths.sum()))
    sizes = np.frombuffer(b"".join(counts), np.int64).reshape(-1, 5)
    sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(sizes[doc_pieces], axis=0)])
    doc_sizes = sums[doc_ends] - sums[doc_ends - lengths]
    digests = [hashlib.sha256(b";".join(map(groups, k))).hexdigest() if k else "" for k in keys]

    pairs, places = np.unique(np.frombuffer(b"".join(codes), np.int64), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes[:, 3])]).astype(np.int64)
    # Documents by pieces, times pieces by pairs: which documents hold which pairs.
    holders = np.zeros(len(pairs), np.int64)
    width = max(1, len(pieces))
    owner = np.repeat(np.arange(len(keys)), lengths)
    entries = np.sort(owner * width + doc_pieces)
    entries = entries[np.diff(entries, prepend=-1) > 0]
    by_piece = Csr(np.searchsorted(entries, np.arange(len(keys) + 1) * width), entries % width,
                   np.ones(len(entries), np.int64), width)
    by_pair = Csr(starts, places.astype(np.int64), np.ones(len(places), np.int64), max(1, len(pairs)))
    if pieces:
        for _, columns, _ in row_products(by_piece, by_pair):
            holders += np.bincount(columns, minlength=len(pairs))

    lists = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (starts[1:], places)]
    docs = [pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids.cast(pa.int64())),
            *[pa.array([doc_sizes[:, i]], pa.list_(pa.int64())) for i in range(5)],
            pa.array([digests], pa.list_(pa.string())),
            *[pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (doc_ends, doc_pieces)]]
    return pairs, holders, pa.RecordBatch.from_arrays([*lists, *docs], names=list(DOCS))


def _stored(number: int, pairs: np.ndarray, holders: np.ndarray, docs: pa.RecordBatch):
    """Batches of a chunk's rows, see STORED."""
    def rows(first: int, n: int, *columns):
        columns = [np.full(n, number), np.arange(first, first + n), *columns]
        return pa.RecordBatch.from_arrays([pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, KINDS)],
                                          names=[c.split()[0] for c in STORED.split(", ")])

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(docs)
    whole = sink.getvalue().to_pybytes()
    starts = range(0, len(whole), PART)
    for i, start in enumerate(starts):
        yield rows(i - len(starts), 1, None, None, [whole[start:start + PART]])
    for i in range(0, len(pairs), ROWS):
        some = slice(i, i + ROWS)
        yield rows(i, len(pairs[some]), pairs[some], holders[some], None)


def _gathered(batches):
    """The documents and the values of each chunk, from rows (chunk, at, value, part) in order of chunk and at."""
    def read():
        with pa.ipc.open_stream(b"".join(parts)) as stream:
            return stream.read_next_batch(), np.concatenate([np.zeros(0, np.int64), *values])

    chunk, parts, values = None, [], []
    for batch in batches:
        chunks, at = (batch.column(i).to_numpy() for i in (0, 1))
        edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            if chunks[start] != chunk:
                if parts:
                    yield read()
                chunk, parts, values = chunks[start], [], []
            first = start + int(np.count_nonzero(at[start:end] < 0))
            parts += batch.column(3).slice(start, first - start).to_pylist()
            values.append(batch.column(2).slice(first, end - first).to_numpy())
    if parts:
        yield read()


def _scores(batches):
    """Per document of a chunk, with the values of its pairs: 2 * count, plus 1 for the best of an A id."""
    for docs, values in _gathered(batches):
        at = {n: docs.column(i)[0] for i, n in enumerate(DOCS)}
        numbers = lambda n: at[n].values.to_numpy(zero_copy_only=False)
        link = values[numbers("piece_pairs")]

        def sums(x, ends):
            total = np.concatenate([[0], np.cumsum(x)])
            return np.diff(total[np.concatenate([[0], ends]).astype(np.int64)])

        pieces, ends = numbers("doc_pieces"), numbers("doc_ends")
        best = sums(sums(link & 1, numbers("piece_ends"))[pieces], ends)
        counts = sums(sums(link >> 1, numbers("piece_ends"))[pieces], ends)
        keep = [at[n].values for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared")]
        yield pa.RecordBatch.from_arrays(
            [*keep, pa.array(best, pa.int64()), pa.array(counts, pa.int64()), at["groups_sha256"].values],
            names=[c.split()[0] for c in ALIGNED.split(", ")])


def chunks_of(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The stored chunks of documents (doc_id, text); see STORED."""
    def run(batches):
        pair, number = None, TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                pair = pair or in_worker(f"pair {path_a} {path_b}", lambda: Pair(path_a, path_b))
                with no_gc():
                    found = _chunk(pair, part.column(0), part.column(1).to_pylist())
                yield from _stored(number, *found)
                number += 1
                del part, found
            del batch  # before the next one comes
        if pair:
            pair.known.forget()  # the worker may be idle from now on

    return write_table(documents.select("doc_id", "text").mapInArrow(freeing(run), STORED), "aligned-chunks")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Per id pair: in how many documents it stands (n), and whether no pair of its A id stands in more (best)."""
    rows = chunks.where("at >= 0")
    counts = write_table(rows.groupBy("pair").agg(F.sum("held").alias("n")), "pair-counts")
    of_a = F.floor(F.col("pair") / SIDE).alias("a")
    most = counts.groupBy(of_a).agg(F.max("n").alias("most"))  # a row per id of A
    return counts.select("pair", "n", of_a).join(most, "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of documents (doc_id, text) what ALIGNED names; n_shared counts the shared-group links."""
    chunks = chunks_of(documents, path_a, path_b)
    value = (F.col("n") * 2 + F.col("best").cast("long")).alias("value")
    values = chunks.where("at >= 0").select("chunk", "at", "pair").join(pair_counts(chunks), "pair").select(
        "chunk", "at", value, F.lit(None).cast("binary").alias("part"))
    parts = chunks.where("at < 0").select("chunk", "at", F.lit(0).cast("long").alias("value"), "part")
    rows = parts.unionAll(values).repartition("chunk").sortWithinPartitions("chunk", "at")
    return rows.mapInArrow(freeing(_scores), ALIGNED)


def links(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The links themselves: per row of documents doc_id and its links, by byte: struct(a, b, first byte, bytes).

    Texts without tokens have none. A text's tokens are aligned as one matrix.
    """
    kind = "doc_id bigint, links array<struct<a: int, b: int, first: bigint, n_bytes: bigint>>"
    shape = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("first", pa.int64()), ("n_bytes", pa.int64())]))

    def run(batches):
        pair = None
        for batch in batches:
            for part in slices(batch, "text"):
                pair = pair or Pair(path_a, path_b)
                rows = []
                for text in part.column(1).to_pylist():
                    pieces = [literal(k) for k in pair.keys(text)]
                    (a, b) = ([i for x in ids for i in x] for ids in pair.ids(pieces)) if pieces else ([], [])
                    whole = (" " + (text or "")).encode()
                    if not pieces or not pair.join_a(a) == whole == pair.join_b(b):
                        rows.append([])
                        continue
                    n_a, n_b = pair.n_a[a], pair.n_b[b]
                    found = align(n_a, n_b).links
                    i, j = found.rows(), found.indices
                    first = np.maximum((np.cumsum(n_a) - n_a)[i], (np.cumsum(n_b) - n_b)[j])
                    rows.append([dict(zip(("a", "b", "first", "n_bytes"), x)) for x in zip(
                        np.array(a)[i].tolist(), np.array(b)[j].tolist(), first.tolist(), found.data.tolist())])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, shape)], names=["doc_id", "links"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)
