"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license notices.

Blocks are windows of words inside a line, each half a window; half a window is STEP
words or the longest notice, so every notice lies whole in a block. With wrapped, there are
also such windows over the words of the whole text, for notices that run over line ends, as
phrases may. The join finds every block that holds at least THRESHOLD of a notice's
distinct words. Notices are much alike (versions, variants), so of these a block meets
only those whose mark, the words that set it apart, stands in it word by word. Tokens are ordered by how
many of all texts hold them, rarest first: a block can reach the threshold only if
it holds one of a notice's first tokens (prefix filter), has enough tokens (length
filter) and enough of them are left from the place of the match on (positional
filter). Only candidates are counted exactly.

Defined results: an empty table gives no rows; a very long text is scanned like others, in a block of its
own; columns other than doc_id and text are ignored; a null text is empty; texts without words have no places and
score 0; each row gets one result, also repeated ones; score is 1 with a phrase,
else the largest containment that reached the threshold, else 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from endpulse.llm.common import write_table
from endpulse.llm.words import LOWER, hash_word, slices, text_bytes, word_hashes

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices, the label that the join adds, and the words that set a notice apart from others like it.
NOTICES = (
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license", "gpl", "terms of the gnu general public license"),
    ("licensed under the gnu general public license version 3", "gpl-3", "gnu general public license version 3"),
    ("licensed under the gnu general public license version 2", "gpl-2", "gnu general public license version 2"),
    ("licensed under the gnu lesser general public license", "lgpl", "lesser general public license"),
    ("licensed under the apache license version 2 0", "apache-2.0", "apache license version 2 0"),
    ("you may not use this file except in compliance with the license", "apache", "compliance with the license"),
    ("released under the mit license", "mit", "mit license"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit",
     "permission is hereby granted"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd",
     "in source and binary forms"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "by nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "by sa"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by", "commons attribution 4 0"),
    ("subject to the terms of the mozilla public license", "mpl", "mozilla public license"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", "permission to use"),
)
STEP = 32
THRESHOLD = 0.8

SCANNED = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
           "base_labels array<string>, blocks array<struct<size:int,tokens:array<int>,marks:array<int>>>")


def notice_tokens(notices=NOTICES) -> list[str]:
    return sorted({w for text, *_ in notices for w in text.split()})


def marks_of(notices=NOTICES) -> list[str]:
    """The mark of each notice; '' (always there) for those of only text and label."""
    return [n[2] if len(n) > 2 else "" for n in notices]


def step_of(notices=NOTICES) -> int:
    """Half a block."""
    return max(STEP, *(len(text.split()) for text, *_ in notices))


def needed(n_tokens: int, threshold: float) -> int:
    """Common tokens that reach the threshold."""
    return math.ceil(threshold * n_tokens - 1e-9)


def _counts(documents: DataFrame, tokens: list[str]) -> dict[str, int]:
    """In how many texts each notice token stands: as many rows as there are tokens."""
    hashes = np.array([hash_word(t) for t in tokens], dtype=np.uint64)
    order = np.argsort(hashes)
    known = hashes[order]

    def count(batches):
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                words, texts, _, _ = word_hashes(*text_bytes(part.column(0)))
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                hit = known[at] == words
                pairs = np.unique(texts[hit] * len(known) + at[hit])
                total += np.bincount(pairs % len(known), minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(order.astype(np.int32)), pa.array(total)], names=["token", "n"])

    rows = documents.select("text").mapInArrow(count, "token int, n bigint").groupBy("token").agg(
        F.sum("n").alias("n")).collect()
    found = {r["token"]: r["n"] for r in rows}
    return {t: found.get(i, 0) for i, t in enumerate(tokens)}


def _same_words(words, begins, ends, raw, at: np.ndarray, phrase: list[str]) -> np.ndarray:
    """Those places of `at` where the phrase's words stand, by hash and then by their bytes."""
    at = at[at + len(phrase) <= len(words)]
    for k, word in enumerate(phrase):
        at = at[words[at + k] == np.uint64(hash_word(word))]
    want = [w.encode() for w in phrase]
    sure = [all(LOWER[raw[begins[i + k]:ends[i + k]]].tobytes() == w for k, w in enumerate(want))
            for i in at.tolist()]
    return at[np.array(sure, dtype=bool)]


def _places(phrase: str, words, texts, begins, ends, raw) -> np.ndarray:
    """The first words of a phrase's places; none runs over the end of a text."""
    phrase = phrase.split()
    first = np.flatnonzero(words == np.uint64(hash_word(phrase[0])))
    first = first[first + len(phrase) <= len(words)]
    first = first[texts[first] == texts[first + len(phrase) - 1]]
    return _same_words(words, begins, ends, raw, first, phrase)


def _scan(documents: DataFrame, phrases, notices, tokens: list[str], prefix: set[int], wrapped: bool) -> DataFrame:
    """Phrase places and candidate blocks of every text, in one pass."""
    hashes = np.array([hash_word(t) for t in tokens], dtype=np.uint64)
    order = np.argsort(hashes)
    known = hashes[order]
    is_prefix = np.isin(order, list(prefix))

    marks, step = marks_of(notices), step_of(notices)

    def blocks_of(part, raw, words, texts, begins, ends):
        """Per text: (size, tokens, marks) of the blocks that hold a prefix token."""
        out = [[] for _ in range(part.num_rows)]
        if not len(words):
            return out
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        hit = known[at] == words
        seeds = np.flatnonzero(hit & is_prefix[at])
        if not len(seeds):
            return out
        marked = [(k, len(m.split()), _places(m, words, texts, begins, ends, raw)) for k, m in enumerate(marks) if m]
        always = [k for k, m in enumerate(marks) if not m]
        newlines = np.flatnonzero(raw == 10)
        line = np.searchsorted(newlines, begins)
        new_text = np.ones(len(words), bool)
        new_text[1:] = texts[1:] != texts[:-1]
        new_line = new_text.copy()
        new_line[1:] |= line[1:] != line[:-1]
        seen = set()
        for new in (new_line, new_text) if wrapped else (new_line,):
            starts = np.flatnonzero(new)
            stops = np.append(starts[1:], len(words))
            for i in seeds.tolist():
                k = int(np.searchsorted(starts, i, side="right")) - 1
                last = (i - starts[k]) // step
                for j in range(max(0, last - 1), last + 1):
                    a = int(starts[k]) + j * step
                    b = min(a + 2 * step, int(stops[k]))
                    if (a, b) in seen:
                        continue
                    seen.add((a, b))
                    held = np.unique(order[at[a:b][hit[a:b]]])
                    inside = [k for k, n, at_words in marked if (
                        m := np.searchsorted(at_words, a)) < len(at_words) and at_words[m] + n <= b]
                    out[texts[a]].append({"size": len(np.unique(words[a:b])), "tokens": held.tolist(),
                                          "marks": always + inside})
        return out

    def scan(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, raw = text_bytes(part.column(part.schema.get_field_index("text")))
                words, texts, begins, ends = word_hashes(offsets, raw)
                n = np.bincount(texts, minlength=part.num_rows)
                before = np.concatenate([[0], np.cumsum(n)])
                places = [[] for _ in range(part.num_rows)]
                for phrase, label in phrases:
                    for i in _places(phrase, words, texts, begins, ends, raw).tolist():
                        places[texts[i]].append((i - int(before[texts[i]]), label))
                starts = [[p for p, _ in x] for x in places]
                yield pa.RecordBatch.from_arrays([
                    part.column(part.schema.get_field_index("doc_id")),
                    pa.array(n, pa.int64()), pa.array([len(x) for x in starts], pa.int64()),
                    pa.array([min(x, default=None) for x in starts], pa.int64()),
                    pa.array([max(x, default=None) for x in starts], pa.int64()),
                    pa.array([sorted({l for _, l in x}) for x in places], pa.list_(pa.string())),
                    pa.array(blocks_of(part, raw, words, texts, begins, ends), pa.list_(pa.struct(
                        [("size", pa.int32()), ("tokens", pa.list_(pa.int32())), ("marks", pa.list_(pa.int32()))])))],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])

    return documents.select("doc_id", "text").mapInArrow(scan, SCANNED)


def scanned(documents: DataFrame, phrases=PHRASES, notices=NOTICES, threshold: float = THRESHOLD,
            wrapped: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), score."""
    spark = documents.sparkSession
    tokens = notice_tokens(notices)
    number = {t: i for i, t in enumerate(tokens)}
    counts = _counts(documents, tokens)
    rank = {t: r for r, t in enumerate(sorted(tokens, key=lambda t: (counts[t], t)))}
    rows, prefix = [], set()
    for k, (text, label, *_) in enumerate(notices):
        ordered = sorted(set(text.split()), key=rank.get)
        need = needed(len(ordered), threshold)
        for place, token in enumerate(ordered[:len(ordered) - need + 1]):
            prefix.add(number[token])
            rows.append((k, label, number[token], place, len(ordered), need,
                         [number[t] for t in ordered]))
    index = spark.createDataFrame(
        rows, "notice int, label string, token int, place int, n int, need int, wanted array<int>")
    ranks = F.array(*[F.lit(rank[t]) for t in tokens])
    texts = write_table(_scan(documents, phrases, notices, tokens, prefix, wrapped).withColumn(
        "row", F.monotonically_increasing_id()), "license-scan")

    blocks = texts.select("row", F.posexplode("blocks").alias("block", "b"))
    blocks = blocks.select("row", "block", "b.size", "b.marks", F.array_sort(F.transform(
        "b.tokens", lambda t: F.struct(F.get(ranks, t).alias("rank"), t.alias("token")))).alias("held"))
    entries = blocks.select("row", "block", "size", "marks", "held", F.posexplode("held").alias("at", "entry"))
    entries = entries.withColumn("token", F.col("entry.token"))
    # Positional filter: the match itself and what can still follow it on both sides; tokens before
    # it in either order cannot match, or the first common token would have been another one.
    left = 1 + F.least(F.col("n") - F.col("place") - 1, F.size("held") - F.col("at") - 1)
    earlier = F.least(F.col("place"), F.col("at"))
    pairs = entries.join(F.broadcast(index), "token").where(  # a row per prefix token of a notice
        (F.col("size") >= F.col("need")) & (left + earlier >= F.col("need")) & F.array_contains("marks", F.col("notice")))
    common = F.size(F.array_intersect("wanted", F.transform("held", lambda x: x["token"])))
    met = (pairs.select("row", "label", "need", "n", common.alias("common")).where("common >= need")
           .groupBy("row").agg(F.collect_set("label").alias("more"),
                               F.max(F.col("common") / F.col("n")).alias("best")))
    none = F.array().cast("array<string>")
    return texts.join(met, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
