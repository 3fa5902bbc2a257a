"""Substring dedup by content-defined chunks of a gear rolling hash.

A byte ends a chunk where the gear hash of the last WINDOW bytes is the smallest
within REACH bytes to both sides (the first of equals), or where a chunk reaches
LONGEST bytes. Both depend on nearby bytes only, so copies of a passage have the
same chunks but for the edges, wherever the passage stands and whatever is
inserted before it. Chunks are compared by digests of 128 bits: the first half finds
candidates among all chunks, the second one tells chance pairs apart. A repeated span is a run of
neighbouring chunks that all occur in other documents too, of MIN_WORDS words or
more (the whole chunks within a passage of 50 words have about 40 of them); its
chunks that are not the first of their digest in the order of (doc_id, row) can be
deleted. A text that repeats only itself has no repeated span.

Defined results: null and empty texts have no chunks; null doc_ids come first;
each row counts as a document of its own, so of repeated rows one is first;
other columns are kept by `without_repeats` and ignored by `repeated_spans`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from endpulse.llm.common import write_table
from endpulse.llm.words import IS_WORD, LOWER, mix, slices, text_bytes

WINDOW = 16  # bytes in the hash: each step shifts by two of 32 bits
REACH = 16
LONGEST = 256
MIN_WORDS = 20

#: A pseudo-random 32-bit value for each byte.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[raw[i - j]] << 2j for j < WINDOW, modulo 2**32, by doubling the window."""
    h = GEAR[raw]
    span = 1
    while span < WINDOW:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(2 * span) if span < len(h) else 0
        h, span = longer, 2 * span
    return h


def _running_min(values: np.ndarray, reach: int) -> np.ndarray:
    """The least of values[i:i + reach], for each i; beyond the end there is nothing."""
    low, span = values.copy(), 1
    while span < reach:
        step = min(span, reach - span)
        low[:-step] = np.minimum(low[:-step], low[step:]) if step < len(low) else low[:-step]
        span += step
    return low


def cut_places(raw: np.ndarray) -> np.ndarray:
    """The ends of the chunks of one text."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.zeros(0, np.int64)
    if n > WINDOW + 2 * REACH:
        h = gear_hashes(raw)
        least = _running_min(h, REACH)  # of h[i:i + REACH]
        i = np.arange(WINDOW + REACH, n - REACH)
        ends = i[(h[i] < least[i - REACH]) & (h[i] <= least[i + 1])] + 1
    edges = np.concatenate([[0], ends, [n]])
    gaps = np.diff(edges)
    if (gaps > LONGEST).any():
        more = [np.arange(a + LONGEST, a + g, LONGEST) for a, g in zip(edges[:-1][gaps > LONGEST], gaps[gaps > LONGEST])]
        edges = np.unique(np.concatenate([edges, *more]))
    return edges[1:]


def _chunk_task(batches):
    digest = hashlib.blake2b
    for batch in batches:
        for part in slices(batch, "text"):
            offsets, raw = text_bytes(part.column(part.schema.get_field_index("text")))
            digests, sizes, counts, owned = [], [], [], [0]  # digests: both halves in turn
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = raw[a:b]
                ends = cut_places(own)
                whole, at = own.tobytes(), 0
                for e in ends.tolist():
                    digests.append(digest(whole[at:e], digest_size=16).digest())
                    at = e
                word = IS_WORD[LOWER[own]]
                first = word.copy()
                first[1:] &= ~word[:-1]
                total = np.concatenate([[0], np.cumsum(first)])
                begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                sizes.append(ends - begins)
                counts.append(total[ends] - total[begins] if len(ends) else ends)
                owned.append(owned[-1] + len(ends))
            lists = lambda x, t: pa.ListArray.from_arrays(pa.array(owned, pa.int32()), pa.array(x, t))
            halves = np.frombuffer(b"".join(digests), np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("row")),
                 part.column(part.schema.get_field_index("doc_id")),
                 lists(halves[::2], pa.int64()), lists(halves[1::2], pa.int64()),
                 lists(np.concatenate(sizes), pa.int32()), lists(np.concatenate(counts), pa.int32())],
                names=["row", "doc_id", "digests", "checks", "sizes", "words"])


_CHUNKS = ("row bigint, doc_id bigint, digests array<bigint>, checks array<bigint>, "
           "sizes array<int>, words array<int>")


def chunked(documents: DataFrame) -> DataFrame:
    """Stored: row number, doc_id, and the digest (in two halves), bytes and words of each chunk."""
    numbered = documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return write_table(numbered.mapInArrow(_chunk_task, _CHUNKS), "chunks")


def repeated_spans(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated span: doc_id, row, first_doc_id, start and n_bytes, n_words, kept, later chunks."""
    return _spans(chunked(documents), min_words)


def _spans(docs: DataFrame, min_words: int) -> DataFrame:
    chunks = docs.select("row", F.explode("digests").alias("digest"))
    common = chunks.groupBy("digest").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a < b").select("digest")
    # A chunk is repeated if both halves are.
    both = docs.select("doc_id", "row", F.posexplode(F.arrays_zip("digests", "checks")).alias("place", "both")).select(
        "doc_id", "row", "place", F.col("both.digests").alias("digest"), F.col("both.checks").alias("check"))
    found = write_table(both.join(common, "digest"), "repeated-chunks")
    here = F.struct("doc_id", "row", "place")
    first = found.groupBy("digest", "check").agg(
        F.min(here).alias("first"), F.min("row").alias("a"), F.max("row").alias("b")).where("a < b").drop("a", "b")
    marked = found.join(first, ["digest", "check"]).select(
        "doc_id", "row", "place", F.col("first.doc_id").alias("first_doc_id"),
        here.eqNullSafe(F.col("first")).alias("is_first"))
    order = Window.partitionBy("row").orderBy("place")
    runs = (marked.withColumn("run", F.col("place") - F.row_number().over(order))
            .groupBy("row", "run").agg(
                F.min("place").alias("a"), F.max("place").alias("b"),
                F.min("first_doc_id").alias("first_doc_id"),
                F.array_sort(F.collect_list(F.when(~F.col("is_first"), F.col("place")))).alias("later")))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
    spans = runs.join(docs.drop("digests"), "row").select(
        "doc_id", "row", "first_doc_id",
        total(F.slice("sizes", F.lit(1), F.col("a"))).alias("start"),
        total(F.slice("sizes", F.col("a") + 1, F.col("b") - F.col("a") + 1)).alias("n_bytes"),
        total(F.slice("words", F.col("a") + 1, F.col("b") - F.col("a") + 1)).alias("n_words"),
        (F.size("later") == 0).alias("kept"), "later", "sizes")
    return spans.where(F.col("n_words") >= min_words)


def without_repeats(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """documents without those chunks of repeated spans that occur earlier; texts stay whole characters."""
    own = {c: f"__own_{i}" for i, c in enumerate(documents.columns) if c in ("row", "__later", "__sizes")}
    numbered = write_table(documents.withColumnsRenamed(own).withColumn(
        "row", F.monotonically_increasing_id()), "rows")
    docs = write_table(numbered.select("row", "doc_id", "text").mapInArrow(_chunk_task, _CHUNKS), "chunks")
    gone = _spans(docs, min_words).where(~F.col("kept")).groupBy("row").agg(
        F.flatten(F.collect_list("later")).alias("__later"), F.first("sizes").alias("__sizes"))
    gone = gone.withColumnRenamed("row", "__gone_row")
    joined = numbered.join(gone, F.col("row") == F.col("__gone_row"), "left").drop("row", "__gone_row")

    def cleaned(batches):
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            texts = []
            for text, later, sizes in zip(*(batch.column(at[c]).to_pylist() for c in ("text", "__later", "__sizes"))):
                if later:
                    data, drop, pos, kept = text.encode(), set(later), 0, []
                    for i, n in enumerate(sizes):
                        if i not in drop:
                            kept.append(data[pos:pos + n])
                        pos += n
                    text = b"".join(kept).decode(errors="ignore")
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(at[n])
                       for n in batch.schema.names if n not in ("__later", "__sizes")]
            yield pa.RecordBatch.from_arrays(columns, names=[
                n for n in batch.schema.names if n not in ("__later", "__sizes")])

    done = joined.mapInArrow(cleaned, joined.drop("__later", "__sizes").schema)
    return done.withColumnsRenamed({v: k for k, v in own.items()}).select(
        *[F.col(f"`{c}`") for c in documents.columns])
