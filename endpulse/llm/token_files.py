"""Token ids in seekable zstandard files.

A shard is a file of independent zstandard frames of FRAME_IDS ids each (32-bit
little-endian), then a skippable frame with the document index (ids and lengths),
then the seek table of the public seekable format as the last skippable frame:
compressed size, decompressed size and checksum (XXH64, low 32 bits) per frame.
A reader opens the tail, finds a document's first id by summing lengths, and
decompresses only the frames that hold it.

Shards follow the documents' order, so that document n+1 starts where n ended. A
task writes a file under a name of its own and names it in the manifest; files
of lost or repeated attempts are in no manifest.

Defined results: a null text is empty, and is the end id alone; null doc_ids come
first; rows of one doc_id follow one another in the order of their texts' hashes,
repeated rows each; other columns are ignored; an empty table has no shard.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from endpulse.llm.common import new_folder, write_table
from endpulse.llm.pieces import Letters
from endpulse.llm.words import freeing, mix, powers, text_bytes

END_ID = 0
FRAME_IDS = 1 << 16
LEVEL = 3
KEPT_PIECES = 400_000
BLOCK = 2 << 20  # bytes of text cut at once
#: Punctuation that begins a new token after a letter.
MARKS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?|*&%$#"])
#: The blanks outside of ASCII: first byte, and what can follow it.
OTHER_BLANKS = {
    0xC2: (b"\x85", b"\xa0"), 0xE1: (b"\x9a\x80",), 0xE3: (b"\x80\x80",),
    0xE2: tuple(chr(c).encode()[1:] for c in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F)),
}
# Fixed values of the seekable format.
SKIPPABLE, TABLE_MAGIC, FOOTER_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = "<III", "<IBI"  # sizes and checksum of a frame; frames, flags and magic number

MANIFEST = "shard int, file string, n_docs bigint, n_ids bigint"


class Encoder:
    """Ids of whole texts; the library encodes each distinct piece once.

    The byte-level pre-tokenizer starts a token at every single blank or line end
    between two other characters, and at a punctuation mark after a letter. So a
    text without neighbouring blanks is cut there without any change of its ids,
    and the pieces of many texts are looked up at once: in a sorted table of
    hashes, with the bytes and the ids of all known pieces behind one another. Every
    piece is compared with the known bytes; a text with a piece that has another one's
    hash, like the other texts, is cut at single blanks only and encoded as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = re.compile(r"(?<=\S)(?= \S)")
        self.line_end = self._ids(["\n"])[0]
        self.letters = Letters(self.tokenizer, head=" ")
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.text_starts, self.text_sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.text_pool, self.text_used = np.zeros(1 << 18, np.uint8), 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)  # without offsets
        return [np.array(f.ids, dtype="<u4") for f in found]

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these pieces, and how many each has; a blank and letters need the tokenizer's model only."""
        fits, letters = self.letters.fits if self.letters.right else (lambda word: False), self.letters
        own = [letters(p[1:]) if p[0] == " " and fits(p[1:]) else None for p in pieces]
        rest = [i for i, ids in enumerate(own) if ids is None]
        counts = np.array([0 if ids is None else len(ids) for ids in own], np.int64)
        of_rest, n_rest = self._together([pieces[i] for i in rest]) if rest else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        counts[rest] = n_rest
        alone = np.ones(len(pieces), bool)
        alone[rest] = False
        ids = np.empty(counts.sum(), "<u4")
        by_model = np.repeat(alone, counts)
        ids[by_model] = np.fromiter(chain.from_iterable(filter(None, own)), "<u4", int(by_model.sum()))
        ids[~by_model] = of_rest
        return ids, counts

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by the whole tokenizer; some hundred are encoded in one text.

        After a line end a piece has the ids that it has alone, unless it begins with a line end itself.
        """
        out, counts = [], []
        for at in range(0, len(pieces), 500):
            part = pieces[at:at + 500]
            ids = self._ids(["\n".join(["", *[p.removeprefix("\n") for p in part], ""])])[0]
            ends = np.flatnonzero(ids == self.line_end[0])
            led = np.array([p[0] == "\n" for p in part])
            # Between two line ends is a piece; the line end before it is its own where it begins with one.
            first = ends[:-1] + ~led
            n = ends[1:] - first
            keep = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            out.append(ids[keep])
            counts.append(n)
        return np.concatenate(out), np.concatenate(counts)

    def _learn(self, keys: np.ndarray, at: np.ndarray, pieces: list[str]) -> None:
        ids, n = self._pieces(pieces)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        texts = [p.encode() for p in pieces]
        text, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
        while self.text_used + len(text) > len(self.text_pool):
            self.text_pool = np.concatenate([self.text_pool, np.zeros(len(self.text_pool), np.uint8)])
        self.text_pool[self.text_used:self.text_used + len(text)] = text
        self.text_starts = np.insert(self.text_starts, at, self.text_used + np.cumsum(sizes) - sizes)
        self.text_sizes = np.insert(self.text_sizes, at, sizes)
        self.text_used += len(text)
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.insert(self.starts, at, self.used + np.cumsum(n) - n)
        self.sizes = np.insert(self.sizes, at, n.astype(np.int32))
        self.used += len(ids)

    def plain(self, offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Which texts can be cut at every blank: no two blanks together, at an end, or of another kind."""
        n = len(raw)
        bad = np.zeros(n, dtype=bool)
        blank = (raw == 32) | (raw == 10)
        bad[1:] = blank[1:] & blank[:-1]
        bad |= ((raw >= 9) & (raw <= 13) & (raw != 10)) | ((raw >= 28) & (raw <= 31))
        filled = np.flatnonzero(offsets[1:] > offsets[:-1])
        edges = np.concatenate([offsets[:-1][filled], offsets[1:][filled] - 1])
        bad[edges] |= blank[edges]
        for lead, rest in OTHER_BLANKS.items():  # blanks of several bytes
            for i in np.flatnonzero(raw == lead).tolist():
                if raw[i + 1:i + 1 + len(rest[0])].tobytes() in rest:
                    bad[i] = True
        for text in self.special:
            mark = text.encode()
            if (whole := raw.tobytes()).find(mark) >= 0:
                bad[[m.start() for m in re.finditer(re.escape(mark), whole)]] = True
        out = np.ones(len(offsets) - 1, dtype=bool)
        out[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = False
        return out

    def batch(self, offsets: np.ndarray, raw: np.ndarray) -> list[bytes]:
        """The ids of each text, as bytes."""
        plain = self.plain(offsets, raw)
        found: list[bytes] = [b""] * len(plain)
        for i in np.flatnonzero(~plain).tolist():
            found[i] = self.other(raw[offsets[i]:offsets[i + 1]].tobytes().decode())
        if not len(raw):
            return found
        begin = (raw == 32) | (raw == 10)
        letter = ((raw | 32) >= 97) & ((raw | 32) <= 122)
        begin[1:] |= letter[:-1] & MARKS[raw[1:]]
        begin[offsets[:-1][offsets[:-1] < len(raw)]] = True
        begins = np.flatnonzero(begin)
        owner = np.searchsorted(offsets, begins, side="right") - 1
        ends = np.append(begins[1:], len(raw))
        keep = plain[owner]
        begins, ends, owner = begins[keep], ends[keep], owner[keep]
        if not len(begins):
            return found
        up, down = powers(len(raw))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * up[:len(raw)], out=total[1:])
        keys = mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64))
        keys, first, place = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > KEPT_PIECES:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            text = raw.tobytes()
            self._learn(keys[new], at[new], [text[begins[i]:ends[i]].decode() for i in first[new].tolist()])
            at = np.searchsorted(self.keys, keys)
        known = at[place]
        wrong = np.unique(owner[~self._same(raw, begins, ends, known)])
        if len(wrong):
            right = ~np.isin(owner, wrong)
            known, owner = known[right], owner[right]
        starts, sizes = self.starts[known], self.sizes[known]
        ids = self.pool[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        per_text = np.bincount(owner, weights=sizes, minlength=len(plain)).astype(np.int64)
        data, edges = ids.astype("<u4").tobytes(), (4 * np.concatenate([[0], np.cumsum(per_text)])).tolist()
        for i in np.flatnonzero(per_text).tolist():
            found[i] = data[edges[i]:edges[i + 1]]
        for i in wrong.tolist():
            found[i] = self.other(raw[offsets[i]:offsets[i + 1]].tobytes().decode())
        return found

    def _same(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Which pieces raw[begin:end] are, byte for byte, the known ones (numbers in the table)."""
        n = ends - begins
        same = self.text_sizes[known] == n
        step = 1 << 16  # pieces at once
        for a in range(0, len(n), step):
            part = slice(a, a + step)
            size = np.where(same[part], n[part], 0)
            base = np.cumsum(size) - size
            place = np.arange(size.sum())
            here = raw[place + np.repeat(begins[part] - base, size)]
            there = self.text_pool[place + np.repeat(self.text_starts[known[part]] - base, size)]
            differ = np.concatenate([[0], np.cumsum(here != there)])
            same[part] &= differ[base + size] == differ[base]
        return same

    def other(self, text: str) -> bytes:
        """Any text: whole if a special token's string is in it, else cut at single blanks."""
        if any(s in text for s in self.special):
            return self._ids([text])[0].tobytes()
        return b"".join(x.tobytes() for x in self._ids(self.cut.split(text)))

    def texts(self, column: pa.Array):
        """The ids of each text of a column, in order."""
        at = 0
        while at < len(column):
            offsets, _ = text_bytes(column.slice(at))
            to = max(1, int(np.searchsorted(offsets, BLOCK, side="right")) - 1)
            if offsets[1] > 4 * BLOCK:
                yield self.long(column[at].as_py())
                to = 1
            else:
                yield from self.batch(*text_bytes(column.slice(at, to)))
            at += to

    def long(self, text: str) -> bytes:
        """A long text in parts, cut before single blanks."""
        if any(s in text for s in self.special):
            return self.other(text)
        out, at = [], 0
        while at < len(text):
            cut = self.cut.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            to = cut.start() if cut else len(text)
            out += self.batch(*text_bytes(pa.array([text[at:to]], pa.string())))
            at = to
        return b"".join(out)

    def __call__(self, text: str) -> bytes:
        return next(self.texts(pa.array([text], pa.string())))


def kept_encoder(path: str) -> Encoder:
    """The worker's encoder; it lives as long as the worker, over all its tasks."""
    kept = sys.modules.setdefault("endpulse_kept_encoders", types.ModuleType("endpulse_kept_encoders"))
    if path not in vars(kept):
        vars(kept)[path] = Encoder(path)
    return vars(kept)[path]


def forget_encoders() -> None:
    """Free what the worker's encoders keep; other stages use the worker too."""
    vars(sys.modules.get("endpulse_kept_encoders", types.ModuleType(""))).clear()


class ShardWriter:
    """Writes one shard; holds one frame of ids and the document index."""

    def __init__(self, stream):
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=LEVEL)
        self.rest, self.entries = bytearray(), []
        self.ids, self.lengths = [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.rest += ids
        while len(self.rest) >= 4 * FRAME_IDS:
            self._frame(bytes(self.rest[:4 * FRAME_IDS]))
            del self.rest[:4 * FRAME_IDS]

    def _frame(self, raw: bytes) -> None:
        packed = self.packer.compress(raw)
        self.stream.write(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> tuple[int, int]:
        if self.rest:
            self._frame(bytes(self.rest))
        none = np.array([d is None for d in self.ids], dtype=np.uint8)
        ids = np.array([0 if d is None else d for d in self.ids], dtype="<i8")
        index = self.packer.compress(struct.pack("<Q", len(ids)) + ids.tobytes() + none.tobytes()
                                     + np.array(self.lengths, dtype="<u8").tobytes())
        self.stream.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.entries.append((len(index) + 8, 0, 0))
        table = b"".join(struct.pack(ENTRY, *e) for e in self.entries)
        table += struct.pack(FOOTER, len(self.entries), CHECKSUMS, FOOTER_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        return len(self.ids), sum(self.lengths)


class ShardReader:
    """Random access to one shard."""

    def __init__(self, file):
        self.file, size = file, file.size()
        tail, each = struct.calcsize(FOOTER), struct.calcsize(ENTRY)
        n, flags, magic = struct.unpack(FOOTER, self._at(size - tail, tail))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table")
        table = self._at(size - tail - n * each, n * each)
        entries = list(struct.iter_unpack(ENTRY, table))
        starts = np.concatenate([[0], np.cumsum([e[0] for e in entries])])
        self.frames = [(int(a), *e) for a, e in zip(starts, entries[:-1])]
        index = zstandard.ZstdDecompressor().decompress(self._at(int(starts[-2]) + 8, entries[-1][0] - 8))
        n_docs = struct.unpack_from("<Q", index)[0]
        self.ids = np.frombuffer(index, "<i8", n_docs, 8)
        self.none = np.frombuffer(index, "u1", n_docs, 8 + 8 * n_docs).astype(bool)
        self.lengths = np.frombuffer(index, "<u8", n_docs, 8 + 9 * n_docs).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def _at(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def frame(self, number: int) -> bytes:
        place, packed, size, checksum = self.frames[number]
        raw = zstandard.ZstdDecompressor().decompress(self._at(place, packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return raw

    def parts(self, doc: int):
        """The bytes of one document's ids, frame by frame; the last frame is kept for the next call."""
        at, end = 4 * int(self.starts[doc]), 4 * int(self.starts[doc + 1])
        while at < end:
            number = at // (4 * FRAME_IDS)
            if getattr(self, "_last", (None,))[0] != number:
                self._last = (number, self.frame(number))
            base = number * 4 * FRAME_IDS
            stop = min(end, base + len(self._last[1]))
            yield self._last[1][at - base:stop - base]
            at = stop


def open_shard(uri: str) -> ShardReader:
    system, path = pa.fs.FileSystem.from_uri(uri)
    return ShardReader(system.open_input_file(path))


def write_shards(documents: DataFrame, tokenizer: str, folder: str | None = None, order=None) -> DataFrame:
    """Encode documents in the given order (default: doc_id) and return the stored manifest."""
    spark = documents.sparkSession
    folder = folder or new_folder(spark, "token-shards")
    order = order or [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = documents.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches):
        writer, number = None, TaskContext.get().partitionId()
        name = f"{folder}/{number:06d}-{TaskContext.get().taskAttemptId()}.zst"
        stream, encode = None, None
        end = struct.pack("<I", END_ID)
        for batch in batches:
            if writer is None and batch.num_rows:
                system, path = pa.fs.FileSystem.from_uri(name)
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                stream = system.open_output_stream(path, compression=None)
                writer, encode = ShardWriter(stream), kept_encoder(tokenizer)
            if batch.num_rows:
                for doc_id, ids in zip(batch.column(0), encode.texts(batch.column(1).fill_null(""))):
                    writer.add(doc_id.as_py(), ids + end)
        if writer is not None:
            n_docs, n_ids = writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [number], "file": [name], "n_docs": [n_docs], "n_ids": [n_ids]},
                schema=pa.schema([("shard", pa.int32()), ("file", pa.string()),
                                  ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return write_table(ranged.mapInArrow(freeing(write), MANIFEST), "manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, read back: doc_id, start, n_tokens, ids_crc32, shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    files = manifest.select("shard", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(batches):
        forget_encoders()  # the shards are written
        for batch in batches:
            for shard, file, base in zip(*(c.to_pylist() for c in batch.columns)):
                reader = open_shard(file)
                sums = np.zeros(len(reader.ids), np.int64)
                for doc in range(len(sums)):
                    crc = 0
                    for part in reader.parts(doc):
                        crc = zlib.crc32(part, crc)
                    sums[doc] = crc
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.ids, mask=reader.none), pa.array(reader.starts[:-1] + base),
                     pa.array(reader.lengths), pa.array(sums), pa.array([shard] * len(sums), pa.int32())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    return files.repartition(max(1, manifest.count())).mapInArrow(
        freeing(read), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int")
