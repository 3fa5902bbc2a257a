"""Payloads read as they land; only changed ones are split into links."""

from pyspark.sql import functions as F, types as T

from ..operators.ingest import changed_lines, changed_sources
from ..sources.snapshots import CommitConflict
from ..sources.tables import payload_columns, read_or_empty
from .results import batches

SEEN = T.StructType([
    T.StructField("link", T.StringType()), T.StructField("data_hash", T.StringType()),
    T.StructField("arrived", T.LongType()), T.StructField("batch", T.LongType()),
])
CHANGED = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("data_hash", T.StringType()),
    T.StructField("arrived", T.LongType()),
])
LINES = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("data_hash", T.StringType()),
    T.StructField("arrived", T.LongType()), T.StructField("line", T.StringType()),
])


def payload_file_stream(spark, path):
    """Payload files as they land in a folder (source, content, arrived)."""
    files = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary").load(path)
    return payload_columns(files)


def source_state(spark, base, folder, before=None, taken=-1):
    """Stored state with what the batches behind ``taken`` (all, or those ``before`` one) have seen.

    ``taken`` is the last batch that the stored state has in it already; what came to that
    state later is newer than it.
    """
    seen = read_or_empty(spark, f"{folder}/seen", SEEN).where(F.col("batch") > taken)
    if before is not None:
        seen = seen.where(F.col("batch") < before)
    latest = seen.groupBy("link").agg(
        F.max(F.struct("batch", "arrived", "data_hash")).alias("last"))
    new = latest.select("link", F.col("last.data_hash").alias("data_hash"))
    return base.join(new, "link", "full_outer").select(
        "link", F.coalesce("data_hash", "last_data_hash").alias("last_data_hash"))


def start_payload_stream(payloads, base, folder, checkpoint, taken=-1):
    """Write the link lines of changed payloads (source, content, arrived).

    A batch compares with the state that earlier batches left behind ``base``, which has
    batches up to ``taken`` in it (``taken_batch``). Its lines and the hashes it saw go to
    folders named by the batch, so a replay replaces them and sees the same state again.
    """

    def write_batch(batch, batch_id):
        spark = batch.sparkSession
        state = source_state(spark, base, folder, before=batch_id, taken=taken)
        changed_path = f"{folder}/changed/batch={batch_id}"
        changed_sources(batch, state).write.mode("overwrite").parquet(changed_path)
        changed = spark.read.schema(CHANGED).parquet(changed_path)
        lines = changed_lines(batch, changed)
        lines_path = f"{folder}/lines/batch={batch_id}"
        lines.write.mode("overwrite").parquet(lines_path)
        written = spark.read.schema(LINES).parquet(lines_path)
        seen = written.select(F.col("source").alias("link"), "data_hash", "arrived").distinct()
        seen.write.mode("overwrite").parquet(f"{folder}/seen/batch={batch_id}")

    return (
        payloads.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def changed_links(spark, folder):
    """(source, line) of all link lines written so far."""
    return read_or_empty(spark, f"{folder}/lines", LINES).where(
        F.col("line").isNotNull()).select("source", "line")


def taken_batch(store, folder):
    """The last batch of this folder that is in the state the store starts from; -1: none."""
    return store.base()[1].get("payload_batches", {}).get(folder, -1)


def compact(store, folder, now, tries=5):
    """Store the source state that the batches left and make it current; starts again after a conflict.

    Only whole batches behind those taken in before are taken, and the last one is noted with the
    state: what another run stored meanwhile stays, and batches that land later are still to come.
    """
    for left in reversed(range(tries)):
        place = store.begin()
        taken = taken_batch(store, folder)
        # A stream's batches end one after the other; `seen` is what a batch writes last.
        last = max([int(name.split("=")[1]) for name in batches(store.spark, f"{folder}/seen")], default=-1)
        state = source_state(store.spark, store.load()["sources"], folder, before=last + 1, taken=taken)
        marks = {**store.base()[1].get("payload_batches", {}), folder: max(last, taken)}
        try:
            return store.commit({"sources": store.write(state, place, "sources", bucketed=False),
                                 "payload_batches": marks}, now)
        except CommitConflict:
            if not left:
                raise
