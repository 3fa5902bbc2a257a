"""Benchmark decontamination by winnowing, in DataFrame functions only.

Fingerprints are the minima of k-word hashes over sliding windows, so every
shared span of SPAN words holds a common fingerprint at the same offset. Texts
and items are joined on fingerprints; each hit is then extended word by word to
both sides, and counts when it reaches SPAN words. An item with fewer words is
one window, and gets fingerprints of its own length.

Defined results: a null text has no words; an item without words has no window;
items with a null id count as one item with an empty id; rows that are equal in
doc_id and text get equal results, one each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from endpulse.llm.common import KEY, cut, key_join, row_key
from endpulse.llm.nativetext import words

SPAN = 13
GRAM = 8
PLACE_BITS = 31  # of a packed fingerprint; the rest is hash


def _shape(span: int) -> tuple[int, int]:
    """Words per gram, grams per window: a shared span of `span` words holds a whole window."""
    gram = min(GRAM, span)
    return gram, span - gram + 1


def _grams(hashes: Column, span: int) -> Column:
    """Hash and place of each gram, packed into a long; null for a text shorter than the span."""
    gram, _ = _shape(span)
    low = F.lit((1 << PLACE_BITS) - 1)

    def packed(i):
        parts = [F.get(hashes, i + j) for j in range(gram)]
        return F.xxhash64(F.lit(span), *parts).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))

    grams = F.transform(F.sequence(F.lit(0), F.size(hashes) - gram), packed)
    return F.when(F.size(hashes) >= span, grams)


def _minima(grams: Column, window: int) -> Column:
    if window == 1:
        return grams
    starts = F.sequence(F.lit(0), F.size(grams) - window)
    return F.array_distinct(F.transform(
        starts, lambda i: F.least(*[F.get(grams, i + j) for j in range(window)])))


def _winnowed(frame: DataFrame, spans: list[int]) -> DataFrame:
    """`frame` has words; one row per fingerprint is added as gram_hash, place and span."""
    frame = frame.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w))).drop("__words")
    # Grams are read several times, so they get a projection of their own.
    frame = frame.withColumns({f"__g{s}": _grams(F.col("__h"), s) for s in spans}).drop("__h")
    none = F.array().cast("array<long>")
    found = [F.coalesce(_minima(F.col(f"__g{s}"), _shape(s)[1]), none) for s in spans]
    # The generator gets an expression, not a column: Spark adds a filter on an exploded
    # column, and pushing that filter down would nest the array expressions.
    others = [c for c in frame.columns if not c.startswith("__g")]
    low = F.lit((1 << PLACE_BITS) - 1)
    return (frame.select(*others, F.explode(F.concat(*found, none)).alias("__fp"))
            .withColumn("gram_hash", F.shiftright("__fp", PLACE_BITS))
            .withColumn("place", F.col("__fp").bitwiseAND(low).cast("int")).drop("__fp"))


def contexts(items: DataFrame, spans: list[int]) -> tuple[DataFrame, DataFrame]:
    """Distinct surroundings of item fingerprints, and which items have them."""
    item = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                        words(F.col("text")).alias("__words")).where(F.size("__words") > 0)
    parts = []
    for span in spans:
        here = item.where(F.size("__words") >= SPAN if span == SPAN else F.size("__words") == span)
        here = here.withColumn("__all", F.col("__words"))
        gram, window = _shape(span)
        found = _winnowed(here, [span])
        before = F.least(F.col("place"), F.lit(window - 1))
        parts.append(found.select(
            "item", "gram_hash", F.lit(span).alias("span"),
            F.reverse(F.slice("__all", F.col("place") - before + 1, before)).alias("before"),
            F.slice("__all", F.col("place") + 1, gram).alias("gram"),
            F.slice("__all", F.col("place") + gram + 1, window - 1).alias("after")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    rows = rows.withColumn("context", F.md5(F.to_json(F.struct("span", "before", "gram", "after"))))
    rows = cut(rows.distinct())
    return (rows.drop("item").distinct(), rows.select("context", "item").distinct())


def _equal_run(words_: Column, wanted: Column, place_of) -> Column:
    """How many of the wanted words, from the first on, stand where place_of(j) says."""
    same = F.transform(wanted, lambda w, j: F.coalesce(F.get(words_, place_of(j)) == w, F.lit(False)))
    miss = F.array_position(same, False)
    return F.when(miss == 0, F.size(wanted)).otherwise(miss - 1).cast("int")


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and its row key."""
    lengths = (items.select(F.least(F.size(words(F.col("text"))), F.lit(SPAN)).alias("n"))
               .where("n > 0").distinct())
    spans = sorted(r["n"] for r in lengths.collect())  # at most SPAN numbers
    docs = documents.select("doc_id", "text", row_key("doc_id", "text").alias(KEY))
    counted = docs.select("doc_id", KEY, F.size(words(F.col("text"))).cast("long").alias("n_words"))
    if not spans:
        return _verdict(counted.select("*", F.lit(0).cast("long").alias("n_hit"),
                                       F.lit(0).cast("long").alias("n_items"), F.lit("").alias("items")))
    surroundings, members = contexts(items, spans)
    prints = _winnowed(docs.select("doc_id", KEY, words(F.col("text")).alias("__words")), spans)
    seeds = prints.join(surroundings, "gram_hash").groupBy("doc_id", KEY).agg(
        F.collect_set(F.struct("place", "context", "span", "before", "gram", "after")).alias("seeds"))

    # Extension: the words of the few texts with a seed, against the seeds' surroundings.
    near = key_join(docs, seeds).select("doc_id", KEY, words(F.col("text")).alias("w"), "seeds")
    w = F.col("w")

    def extended(s):
        left = _equal_run(w, s["before"], lambda j: s["place"] - 1 - j)
        core = _equal_run(w, s["gram"], lambda j: s["place"] + j)
        right = _equal_run(w, s["after"], lambda j: s["place"] + F.size(s["gram"]) + j)
        return F.struct(s["context"].alias("context"), s["span"].alias("span"),
                        (core == F.size(s["gram"])).alias("whole"),
                        (s["place"] - left).alias("first"),
                        (s["place"] + core + right - 1).alias("last"))

    hits = near.withColumn("runs", F.transform("seeds", extended)).withColumn("runs", F.filter(
        "runs", lambda r: r["whole"] & (r["last"] - r["first"] + 1 >= r["span"])))
    hits = hits.select(
        "doc_id", KEY,
        F.size(F.array_distinct(F.flatten(F.transform(
            "runs", lambda r: F.sequence(r["first"], r["last"]))))).cast("long").alias("n_hit"),
        F.explode(F.array_distinct(F.transform("runs", lambda r: r["context"]))).alias("context"))
    found = hits.join(members, "context").groupBy("doc_id", KEY).agg(
        F.max("n_hit").alias("n_hit"), F.collect_set("item").alias("__items")).select(
        "doc_id", KEY, "n_hit", F.size("__items").cast("long").alias("n_items"),
        F.concat_ws(",", F.array_sort("__items")).alias("items"))
    joined = key_join(counted, found, "left").select(
        "doc_id", KEY, "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"))
    return _verdict(joined)


def _verdict(frame: DataFrame) -> DataFrame:
    return frame.select(
        "doc_id", KEY, "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def without_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of documents that are not contaminated, with all their columns."""
    own = {c: f"__own_{i}" for i, c in enumerate(documents.columns) if c not in ("doc_id", "text")}
    documents = documents.withColumnsRenamed(own)
    judged = contaminated(documents, items).where("contaminated").select("doc_id", KEY).distinct()
    keyed = documents.withColumn(KEY, row_key("doc_id", "text"))
    return key_join(keyed, judged, "left_anti").drop(KEY).withColumnsRenamed({v: k for k, v in own.items()})
