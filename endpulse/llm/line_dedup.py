"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A run is RUN consecutive lines. Each run is hashed whole, with the minimum over its
grams of GRAM line hashes as its fingerprint. Runs whose fingerprint occurs once are
dropped; equal runs are found by grouping the others on their own 128-bit hash, which
stands for joining and extending positions (see README). Of equal runs all but the
first in the order of (doc_id, row key, line) are repeated, and their lines are
deleted; overlapping runs make longer repeats.

Defined results: a null text has no lines and stays null; an empty text has one
empty line; a text of fewer lines than a run stays whole; rows equal in doc_id
and text are one document, and get equal results, one each; null doc_ids come
first; other columns are kept as they are.

With min_words, runs of fewer than RUN lines count too if they hold that many
words, and a text of fewer lines than RUN is one run as a whole, which repeats
equal whole texts only. op2_line_dedup has it on. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from endpulse.llm.common import KEY, key_join, row_key, write_table
from endpulse.llm.nativetext import words

RUN = 3
GRAM = 2
WINDOW = RUN - GRAM + 1


def _short_runs(documents: DataFrame, min_words: int) -> DataFrame:
    """Runs of fewer than RUN lines with min_words words, and whole texts of fewer lines; each its own fingerprint."""
    docs = documents.where("text IS NOT NULL").select(
        "doc_id", row_key("doc_id", "text").alias(KEY), F.transform(F.split("text", "\n"), lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), F.size(words(x)).alias("w"))).alias("h"))
    h = F.col("h")

    def run(i, n, whole):
        at = [F.get(h, i + j) for j in range(n)]
        a = F.xxhash64(F.lit(n), F.lit(whole), *[x["a"] for x in at])
        return F.struct(i.cast("int").alias("line"), F.lit(n).alias("n_lines"), a.alias("fingerprint"),
                        a.alias("run_a"), F.xxhash64(F.lit(n), F.lit(whole), *[x["b"] for x in at]).alias("run_b"))

    def enough(n):
        return lambda i: sum((F.get(h, i + j)["w"] for j in range(n)), F.lit(0)) >= min_words

    def inside(n):
        return lambda i: run(i, n, False)

    def is_whole(n):
        return lambda _: F.size(h) == n

    kinds = []
    for n in range(1, RUN):
        starts = F.when(F.size(h) >= n, F.sequence(F.lit(0), F.size(h) - n)).otherwise(F.array().cast("array<int>"))
        kinds.append(F.transform(F.filter(starts, enough(n)), inside(n)))
        kinds.append(F.filter(F.array(run(F.lit(0), n, True)), is_whole(n)))
    return docs.select("doc_id", KEY, F.explode(F.concat(*kinds)).alias("run")).select("doc_id", KEY, "run.*")


def _runs(documents: DataFrame) -> DataFrame:
    """One row per run of lines: its place, its fingerprint, and 128 bits for its content."""
    docs = documents.select("doc_id", row_key("doc_id", "text").alias(KEY),
                            F.split("text", "\n").alias("lines"))
    docs = docs.where(F.size("lines") >= RUN).select(
        "doc_id", KEY,
        F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"),
                                                F.xxhash64(F.lit(1), x).alias("b"))).alias("h"))
    h = F.col("h")
    docs = docs.withColumn("grams", F.transform(
        F.sequence(F.lit(0), F.size(h) - GRAM),
        lambda i: F.xxhash64(*[F.get(h, i + j)["a"] for j in range(GRAM)])))

    def run(i):
        at = [F.get(h, i + j) for j in range(RUN)]
        return F.struct(
            i.cast("int").alias("line"), F.lit(RUN).alias("n_lines"),
            F.least(*[F.get(F.col("grams"), i + j) for j in range(WINDOW)]).alias("fingerprint"),
            F.xxhash64(*[x["a"] for x in at]).alias("run_a"),
            F.xxhash64(*[x["b"] for x in at]).alias("run_b"))

    docs = docs.withColumn("run", F.explode(F.transform(F.sequence(F.lit(0), F.size(h) - RUN), run)))
    return docs.select("doc_id", KEY, "run.*")


def repeated_lines(documents: DataFrame, min_words: int | None = None) -> DataFrame:
    """doc_id, row key and the sorted numbers of the lines to delete, for documents that have any."""
    runs = _runs(documents)
    if min_words is not None:
        runs = runs.unionByName(_short_runs(documents, min_words))
    # Runs of equal rows are all the first one or none is, so they are made distinct at the end, where few are left.
    runs = write_table(runs, "line-runs")
    common = runs.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint")
    candidates = runs.join(common, "fingerprint").select(
        "doc_id", KEY, "line", "n_lines", "run_a", "run_b")
    first = candidates.groupBy("n_lines", "run_a", "run_b").agg(
        F.min(F.struct("doc_id", KEY, "line")).alias("first"), F.count("*").alias("n")).where("n > 1")
    here = F.struct("doc_id", KEY, "line")
    again = (candidates.join(first, ["n_lines", "run_a", "run_b"]).where(~here.eqNullSafe(F.col("first")))
             .groupBy("doc_id", KEY, "line").agg(F.max("n_lines").alias("n_lines"))
             .select("doc_id", KEY, F.sequence(F.col("line"), F.col("line") + F.col("n_lines") - 1).alias("gone")))
    return again.groupBy("doc_id", KEY).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def dedup_lines(documents: DataFrame, min_words: int | None = None) -> DataFrame:
    """documents with later repeated runs deleted from text, plus n_lines and deleted_lines (numbers from 0)."""
    docs = documents.withColumn(KEY, row_key("doc_id", "text"))
    gone = repeated_lines(documents, min_words)
    none = F.array().cast("array<int>")
    joined = key_join(docs, gone.withColumnRenamed("gone", "__gone"), "left").select(
        *[F.col(f"`{c}`") for c in documents.columns if c not in ("n_lines", "deleted_lines")],
        F.coalesce(F.split("text", "\n"), F.array().cast("array<string>")).alias("__lines"),
        F.coalesce("__gone", none).alias("deleted_lines"))
    n = F.size("__lines")
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("deleted_lines"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")
    return (joined.withColumn("text", F.when(F.size("deleted_lines") == 0, F.col("text")).otherwise(kept))
            .withColumn("n_lines", n.cast("long")).drop("__lines"))
