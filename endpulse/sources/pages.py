"""Pages of the catalogue in order of hash, each out of one file or two.

The catalogue is bucketed by hash, so every file holds hashes of the whole
range and a page would read them all. Here its living endpoints are stored once
more with three columns, cut by ranges of the hash into files of about equal
size; the bounds and the rows of each file stand in the log beside the table (one
entry per file). A page reads the files that its bounds and its number of rows
name, and nothing else.

The pages belong to one catalogue. Once a run committed another one they
are out of date, and a page is read from the catalogue until they are stored again.
"""

from pyspark.sql import functions as F

from ..operators.select import keyset_page

COLUMNS = ("proxy_hash", "raw_link", "scheme")


def write_pages(store, folder, files=None):
    """Write the pages of the store's current catalogue; returns their entry for the log."""
    catalog = store.load()["catalog"].select(*COLUMNS)
    ranged = catalog.repartitionByRange(files or store.buckets, "proxy_hash").sortWithinPartitions("proxy_hash")
    entry = store.write(ranged, folder, "pages", bucketed=False)
    bounds = store.read(entry).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("proxy_hash").alias("first"), F.max("proxy_hash").alias("last"), F.count("*").alias("n"))
    # One row per file, as many as partitions were asked for.
    return entry | {"files": [list(r) for r in bounds.orderBy("first").collect()], "of": _catalog_path(store)}


def store_pages(store, now, files=None):
    """Commit the pages of the current catalogue; returns the run's number."""
    return store.commit({"pages": write_pages(store, store.begin(), files)}, now)


def read_page(store, limit, after=None):
    """The next ``limit`` endpoints after a hash, like ``keyset_page`` of the current catalogue."""
    entry = store.base()[1].get("pages")
    if entry is None or entry["of"] != _catalog_path(store):
        return keyset_page(store.load()["catalog"], limit, after)
    rows = store.read(entry)
    names = page_files(entry["files"], limit, after)
    if not names:
        return keyset_page(rows.limit(0), limit)
    return keyset_page(store.spark.read.schema(rows.schema).parquet(*names), limit, after)


def page_files(files, limit, after=None):
    """Names of the files (file, first, last, n, in order) that hold the page."""
    names, sure = [], 0
    for name, first, last, n in files:
        if after is not None and last <= after:
            continue
        names.append(name)
        # Of a file that begins at or before ``after``, one row is all that is certain.
        sure += n if after is None or first > after else 1
        if sure >= limit:
            break
    return names


def _catalog_path(store):
    return store.base()[1].get("catalog", {}).get("path")
