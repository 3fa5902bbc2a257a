"""Attempts of tests as they arrive.

Of each test a micro-batch keeps the first attempts that it holds, as many as count at
most, in a folder named by the stream and the batch. The first attempts of all are the
first of those, whatever the order of arrival: a late attempt counts as if it had been
in time, and one that comes twice counts once (of different rows with one attempt_seq
the least). So a test takes ``max_attempts`` narrow rows of state, however often it was tried.

``compact`` folds what has landed into one stored table, without the tests whose
outcomes are done with, and notes the last batch of each stream that it took in. A
stream that lost its checkpoint is a new one: what it replays is folded in again, which
changes nothing. ``expire_batches`` removes the folders that a commit has taken in.
"""

import json

from pyspark.sql import Window, functions as F

from ..operators.attempts import ATTEMPTS
from ..sources.snapshots import KEY, CommitConflict
from .results import batches


def first_attempts(rows, key=KEY, max_attempts=ATTEMPTS):
    """The first ``max_attempts`` different attempts of each test.

    One shuffle: Spark limits the rank on the map side, and the grouping needs the same partitions.
    """
    order = Window.partitionBy(key).orderBy("attempt_seq")
    values = [c for c in rows.columns if c not in (key, "attempt_seq")]
    return (
        rows.withColumn("rank_in_key", F.dense_rank().over(order))
        .where(F.col("rank_in_key") <= max_attempts)
        .groupBy(key, "attempt_seq").agg(F.min(F.struct(*values)).alias("values_of_row"))
        .select(*[F.col(f"values_of_row.{c}").alias(c) if c in values else F.col(c) for c in rows.columns])
    )


def _stream_id(spark, checkpoint):
    """The name that Spark gave the query; it lives and dies with the checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def start_attempts_stream(attempts, folder, checkpoint, key=KEY, max_attempts=ATTEMPTS):
    """Fold all attempts that are there into ``folder``; returns the query."""

    def write_batch(batch, batch_id):
        name = f"batch={_stream_id(batch.sparkSession, checkpoint)}.{batch_id:012d}"
        first_attempts(batch, key, max_attempts).write.mode("overwrite").parquet(f"{folder}/{name}")

    return (
        attempts.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _place(name):
    """(stream, number) of a batch's folder."""
    stream, number = name.removeprefix("batch=").rsplit(".", 1)
    return stream, int(number)


def _pending(spark, folder, marks):
    return [n for n in batches(spark, folder) if _place(n)[1] > marks.get(_place(n)[0], -1)]


def _fold(spark, folder, names, schema, stored, key, max_attempts):
    """``stored`` None: nothing is stored yet."""
    if names:
        landed = spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in names])
        stored = landed if stored is None else stored.unionByName(landed)
    elif stored is None:
        stored = spark.createDataFrame([], schema)
    return first_attempts(stored, key, max_attempts)


def stored_attempts(store, folder):
    """(attempts taken in, or None, and the last batch of each stream among them) of the store's state."""
    entry = store.base()[1].get(f"attempts {folder}")
    return (store.read(entry), entry["marks"]) if entry else (None, {})


def attempts_so_far(store, folder, schema, key=KEY, max_attempts=ATTEMPTS):
    """The first attempts of each test, of all that has landed; ``schema`` is that of the attempts."""
    stored, marks = stored_attempts(store, folder)
    return _fold(store.spark, folder, _pending(store.spark, folder, marks), schema, stored, key, max_attempts)


def compact(store, folder, schema, now, key=KEY, max_attempts=ATTEMPTS, done=None, tries=5):
    """Store the first attempts and make them current; starts again after a conflict.

    ``done`` holds keys of tests that no attempt is awaited for; they leave the state.
    """
    for left in reversed(range(tries)):
        place = store.begin()
        stored, marks = stored_attempts(store, folder)
        names = _pending(store.spark, folder, marks)
        rows = _fold(store.spark, folder, names, schema, stored, key, max_attempts)
        if done is not None:
            rows = rows.join(done.select(key).distinct(), key, "left_anti")
        for stream, number in map(_place, names):
            marks = {**marks, stream: max(number, marks.get(stream, -1))}
        entry = store.write(rows, place, "attempts", bucketed=key == KEY)
        try:
            return store.commit({f"attempts {folder}": {**entry, "marks": marks}}, now)
        except CommitConflict:
            if not left:
                raise


def expire_batches(store, folder):
    """Remove the folders of batches that the current state has taken in; returns how many.

    For a time when nobody reads an older state.
    """
    spark = store.spark
    store.begin()
    marks = stored_attempts(store, folder)[1]
    taken = [n for n in batches(spark, folder) if _place(n)[1] <= marks.get(_place(n)[0], -1)]
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in taken:
        files.delete(path(f"{folder}/{name}"), True)
    return len(taken)
