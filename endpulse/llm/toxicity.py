"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the hashes of its words, word pairs and pairs with one word
between, each present or not. FTRL-proximal gives every coordinate its own
learning rate, and its L1 part leaves most weights zero, so that the model is a
short list of (feature, weight), at most 2**BITS of them, which is broadcast.

The model is fitted on at most `sample` labelled documents (those of the smallest
doc_id hash, one row each, MOST_FEATURES features at most), in one task: the sample bounds its memory. Scoring reads every
whole text.

Defined results: null and empty texts get the score of the bias alone; labels
that are null teach nothing, of several labels of a document the largest counts;
without any label all scores are 0; a null doc_id counts as the text ''; repeated
rows are scored each.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from endpulse.llm.words import gram_hashes, mix, slices, text_bytes, word_hashes

BITS = 20
GRAMS = ((0,), (0, 1), (0, 2))  # words, pairs, pairs around one word
SAMPLE = 16_384
MOST_FEATURES = 8_192  # of one example; with SAMPLE this bounds what the fit holds in bytes
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 3.0, 0.01, 6
FOLDS = 5


def features(offsets: np.ndarray, raw: np.ndarray):
    """Text number and feature number, one pair per occurrence."""
    hashes, texts, _, _ = word_hashes(offsets, raw)
    found, owners = [], []
    for steps in GRAMS:
        grams = gram_hashes(hashes, steps)
        same = texts[:len(grams)] == texts[steps[-1]:steps[-1] + len(grams)]
        found.append((grams[same] >> np.uint64(64 - BITS)).astype(np.int32))
        owners.append(texts[:len(grams)][same])
    return np.concatenate(owners), np.concatenate(found)


def fit(examples, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, weights and bias from a list of (feature numbers, label 0 or 1)."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias, seen = 0.0, 1.0

    def weights(at):
        zs = z[at]
        rate = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / rate)

    for _ in range(epochs):
        for at, label in examples:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - label
            squares = n[at]
            z[at] += g - (np.sqrt(squares + g * g) - np.sqrt(squares)) / ALPHA * w
            n[at] = squares + g * g
            seen += g * g
            bias -= ALPHA / np.sqrt(seen) * g
    every = np.flatnonzero(np.abs(z) > L1)
    return every, weights(every), bias


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def _examples(batches):
    """Distinct features of each labelled text; of a text with very many those of the least hashes."""
    for batch in batches:
        for part in slices(batch, "text"):
            texts, found = features(*text_bytes(part.column(part.schema.get_field_index("text"))))
            pairs = np.unique(texts.astype(np.int64) << BITS | found)
            cuts = np.searchsorted(pairs >> BITS, np.arange(part.num_rows + 1))
            for i in np.flatnonzero(np.diff(cuts) > MOST_FEATURES)[::-1].tolist():
                own = np.arange(cuts[i], cuts[i + 1])
                order = np.argsort(mix((pairs[own] & (1 << BITS) - 1).astype(np.uint64)), kind="stable")
                pairs = np.delete(pairs, own[order[MOST_FEATURES:]])
            cuts = np.searchsorted(pairs >> BITS, np.arange(part.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                             pa.array(pairs & (1 << BITS) - 1, pa.int32()))
            keep = [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "toxic")]
            yield pa.RecordBatch.from_arrays([*keep, lists], names=["doc_id", "toxic", "found"])


def _fit_task(batches):
    """All examples, in one task, in the order of their ids' checksums."""
    rows = []
    for batch in batches:
        flat = batch.column(2)
        for i, (doc, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            found = flat[i].values.to_numpy(zero_copy_only=False)
            rows.append((zlib.crc32(b"%d" % doc), doc, len(found), found, label))
    rows.sort(key=lambda r: r[:3])
    if rows:
        every, weights, bias = fit([(r[3], r[4]) for r in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(every, -1).astype(np.int32)), pa.array(np.append(weights, bias))],
            names=["feature", "weight"])


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights (feature -1: the bias), from labelled rows outside of the held-out fold."""
    taught = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    taught = taught.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64("doc_id")
    rows = taught.count()
    if rows > 2 * sample:  # thin out first, so that no task sends much more than the sample
        taught = taught.where(F.pmod(order, F.lit(1 << 20)) < (2 * sample << 20) // rows)
    chosen = taught.orderBy(order, "doc_id").limit(sample)
    taught = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # `sample` rows at most
    # Of several rows of one doc_id the one whose text has the least hash.
    one = taught.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "toxic")).alias("x"))
    rows = (one.select("doc_id", "x.text", "x.toxic")
            .mapInArrow(_examples, "doc_id bigint, toxic int, found array<int>")
            .repartition(1).mapInArrow(_fit_task, "feature int, weight double"))
    model = rows.toPandas()  # 2**BITS + 1 rows at most, a few thousand in fact
    return model["feature"].to_numpy(np.int32), model["weight"].to_numpy(np.float64)


def scored(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """documents plus score (0 to 1) and predicted (1 from 0.5 on), in place of columns of these names."""
    found, weights = train(documents, labels, sample)
    model = documents.sparkSession.sparkContext.broadcast((found, weights))
    named = [c for c in documents.columns if c not in ("score", "predicted")]
    source = documents.select(*[F.col(f"`{c}`") for c in named])

    def score(batches):
        numbers, values = model.value
        table = np.zeros(1 << BITS)
        table[numbers[numbers >= 0]] = values[numbers >= 0]
        bias = values[numbers < 0].sum() if len(numbers) else -np.inf
        for batch in batches:
            for part in slices(batch, "text"):
                texts, at = features(*text_bytes(part.column(part.schema.get_field_index("text"))))
                hit = table[at] != 0
                pairs = np.unique(texts[hit].astype(np.int64) << BITS | at[hit])
                total = np.bincount(pairs >> BITS, weights=table[pairs & (1 << BITS) - 1],
                                    minlength=part.num_rows) + bias
                p = 1 / (1 + np.exp(-np.clip(total, -700, 700)))
                p[np.isneginf(total)] = 0.0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                    names=[*part.schema.names, "score", "predicted"])

    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return source.mapInArrow(score, schema)


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents that are not predicted toxic, with all their columns."""
    own = {c: f"__own_{c}" for c in documents.columns if c in ("score", "predicted")}
    kept = scored(documents.withColumnsRenamed(own), labels).where("predicted = 0").drop("score", "predicted")
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(
        *[F.col(f"`{c}`") for c in documents.columns])
