"""Test results applied as they arrive.

Each micro-batch writes its results folded to one row per endpoint, in a
folder named by the batch, so a replayed batch replaces itself. The catalogue
is not rewritten per batch: readers fold the few pending rows per endpoint
into it, and ``compact`` stores the outcome now and then, with the seq of the last
result behind each value and the names of the batches it took in. So batches that
land meanwhile stay pending, and an old result that comes late changes nothing.
"""

from pyspark.sql import functions as F, types as T

from ..operators.catalog import METRICS, flat_fold, fold_results, refold, update_catalog
from ..schemas import RESULTS
from ..sources.snapshots import CommitConflict


def _stamped(value_type):
    return T.StructType([T.StructField("seq", T.LongType()), T.StructField("v", value_type)])


_OUTCOME = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("reason", T.StringType())])
FOLDED = T.StructType(
    [T.StructField("proxy_hash", T.StringType()), T.StructField("outcome", _stamped(_OUTCOME))]
    + [T.StructField(m, _stamped(RESULTS[m].dataType)) for m in METRICS])


def start_results_stream(results, folder, checkpoint):
    """Fold all results that are there into ``folder``; returns the query."""

    def write_batch(batch, batch_id):
        fold_results(batch).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return (
        results.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def batches(spark, folder):
    """Names of the batches that have landed whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith("batch=")]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(p.getName() for p in done)


def folded_batches(spark, folder, names):
    """One fold out of the named batches."""
    if not names:
        return spark.createDataFrame([], FOLDED)
    return refold(spark.read.schema(FOLDED).parquet(*[f"{folder}/{n}" for n in names]))


def newer(folded, applied):
    """Of a fold, only what came after the results that are applied already."""
    known = applied.select("proxy_hash", *[F.col(f"{c}.seq").alias(f"{c}_seq") for c in ("outcome", *METRICS)])
    return folded.join(known, "proxy_hash", "left").select("proxy_hash", *[
        F.when(F.col(f"{c}_seq").isNull() | (F.col(f"{c}.seq") > F.col(f"{c}_seq")), F.col(c)).alias(c)
        for c in ("outcome", *METRICS)])


def current_catalog(spark, catalog, folder, now, applied=None, taken=()):
    """The catalogue with the batches that are not ``taken`` in yet."""
    folded = folded_batches(spark, folder, [n for n in batches(spark, folder) if n not in set(taken)])
    if applied is not None:
        folded = newer(folded, applied)
    return update_catalog(catalog, flat_fold(folded), now)


def stream_state(store, folder):
    """(applied results, names of the batches taken in) of the state the store starts from."""
    tables = store.base()[1]
    applied = store.read(tables["applied"]) if "applied" in tables else store.spark.createDataFrame([], FOLDED)
    return applied, tables.get("batches", {}).get(folder, [])


def compact(store, folder, now, tries=5):
    """Store the catalogue with the pending results and make it current; starts again after a conflict."""
    spark = store.spark
    for left in reversed(range(tries)):
        place = store.begin()
        applied, taken = stream_state(store, folder)
        pending = [n for n in batches(spark, folder) if n not in set(taken)]
        folded = folded_batches(spark, folder, pending)
        catalog = update_catalog(store.load()["catalog"], flat_fold(newer(folded, applied)), now)
        entries = {"catalog": store.write(catalog, place, "catalog", counted="last_status"),
                   "applied": store.write(refold(applied.unionByName(folded)), place, "applied"),
                   "batches": {**store.base()[1].get("batches", {}), folder: sorted({*taken, *pending})}}
        try:
            return store.commit(entries, now)
        except CommitConflict:
            if not left:
                raise
