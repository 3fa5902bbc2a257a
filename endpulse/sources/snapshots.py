"""Snapshots of the state tables.

Plain Parquet tables know no MERGE, so a run writes new tables beside the old
ones and then adds one file to a small log; the newest file names the current
tables. A run that fails before that file leaves the state as it was. The file is
written whole under another name and then gets its own, the number after that of the
state the run began with, only if there is none: a writer that dies leaves no
half-written log, and of two runs that began with the same state one commits
and the other gets a CommitConflict; it has to begin again.

A folder of a run holds a manifest: a file for each table that is whole. A run that
begins with the same state and the same key gets the same folder, and goes on from there.

The big tables are bucketed and sorted by ``proxy_hash``, so the catalogue, the
dead-list and the link facts are joined without shuffling any of them. The
number of buckets follows spark.sql.shuffle.partitions, which lets fresh rows
be shuffled once, straight into the buckets.

``expire_runs`` removes the folders of older runs, once nobody reads them any more, and
those of runs that began with an older state and so can never commit.
"""

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F, types as T

from ..operators.catalog import is_dead, status_counts
from ..schemas import CATALOG, DEAD, SELECTED, SOURCE_STATE

KEY = "proxy_hash"
STATUS = "last_status"
# Most values of a column whose counts go into the log.
MOST_COUNTS = 1000
STATE = {"catalog": CATALOG, "dead": DEAD, "selected": SELECTED, "sources": SOURCE_STATE}


class CommitConflict(Exception):
    """Somebody else committed since this run began."""


class SnapshotStore:
    def __init__(self, spark, root, buckets=None):
        self.spark = spark
        self.root = root.rstrip("/")
        # The number of partitions that Spark gives a shuffle at first.
        self.buckets = buckets or int(spark.conf.get(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            spark.conf.get("spark.sql.shuffle.partitions")))
        self._registered = []
        self._base = None

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/log")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _log(self):
        """Paths of the log's files by run number."""
        files, path = self._files()
        if not files.exists(path):
            return {}
        names = [(s.getPath().getName(), s.getPath().toString()) for s in files.listStatus(path) if s.getLen()]
        return {int(name.split(".")[0]): full for name, full in names if name.split(".")[0].isdigit()}

    def _entry(self, path):
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def current(self):
        """(run number, tables by name) of the newest finished run."""
        log = self._log()
        return (max(log), self._entry(log[max(log)])["tables"]) if log else (0, {})

    def begin(self, key=None):
        """A folder for the tables of one run, which starts from the state as it is now.

        A run with a ``key`` gets the same folder again while the state is the same.
        """
        self._base = self.current()
        return f"{self.root}/runs/{self._base[0]:012d}-{key or uuid.uuid4().hex}"

    def finished(self, folder, name):
        """The entry of a table that an earlier attempt of this run wrote whole, or None."""
        files, _ = self._files()
        path = f"{folder}/manifest/{name}.json"
        return self._entry(path) if files.exists(self._path(path)) else None

    def finish(self, folder, name, entry):
        """Note in the run's manifest that this table is whole."""
        self._put(f"{folder}/manifest", f"{name}.json", {k: v for k, v in entry.items() if k != "table"})

    def clear(self, path):
        """Remove what an attempt that died may have left of a table."""
        self._files()[0].delete(self._path(path), True)

    def _path(self, path):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _put(self, folder, name, content):
        """Write a file whole under a name that is free; False if it is taken."""
        jvm, (files, _) = self.spark._jvm, self._files()
        part, target = self._path(f"{folder}/_{uuid.uuid4().hex}.part"), self._path(f"{folder}/{name}")
        files.mkdirs(self._path(folder))
        try:
            out = files.create(part, False)
            out.write(bytearray(json.dumps(content).encode()))
            out.close()
            if files.exists(target) and not files.getFileStatus(target).getLen():
                files.delete(target, False)  # no writer leaves an empty file; one that died long ago did
            if self._links(files):
                local = lambda p: jvm.java.nio.file.Paths.get(p.toUri())
                jvm.java.nio.file.Files.createLink(local(files.makeQualified(target)), local(files.makeQualified(part)))
            else:
                self._rename(files, part, target)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        finally:
            files.delete(part, False)
        return True

    def _links(self, files):
        """In a local folder renaming would overwrite; a link does not."""
        return files.getUri().getScheme() == "file"

    def _rename(self, files, part, target):
        """Rename without overwriting, as distributed file systems do in one step."""
        jvm = self.spark._jvm
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration()).rename(
                files.makeQualified(part), files.makeQualified(target), how)

    def write(self, df, folder, name, bucketed=True, spread=False, counted=None):
        """Write a table; returns its entry for the log.

        Rows that come out of a join or group on the key are in their buckets
        already. Others need ``spread``, or each task writes to every bucket.
        With ``counted``, a column of few values, the entry tells how many written
        rows hold each; only that column is read for it.
        """
        entry = self._write(df, folder, name, bucketed, spread)
        if counted:
            values = df.sparkSession.read.schema(df.select(counted).schema).parquet(entry["path"])
            counts = values.groupBy(counted).agg(F.count("*").alias("n")).take(MOST_COUNTS + 1)
            if len(counts) <= MOST_COUNTS:
                entry["counts"] = {"column": counted, "rows": sorted(([*r] for r in counts), key=repr)}
        return entry

    def _write(self, df, folder, name, bucketed, spread):
        path = f"{folder}/{name}"
        if spread:
            df = df.repartition(self.buckets, KEY)
        writer = df.write.mode("errorifexists").format("parquet")
        if bucketed:
            table = self._name()
            writer.bucketBy(self.buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(table)
            return {"path": path, "buckets": self.buckets, "schema": df.schema.json(),
                    "table": table}
        writer.save(path)
        return {"path": path, "schema": df.schema.json()}

    def read(self, entry):
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if not entry.get("buckets"):
            return self.spark.read.schema(schema).parquet(entry["path"])
        if entry.get("table") not in self._registered:
            entry["table"] = self._name()
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            path = entry["path"].replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {entry['table']} ({columns}) USING parquet "
                f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {entry['buckets']} BUCKETS "
                f"LOCATION '{path}'")
        return self.spark.table(entry["table"])

    def base(self):
        """(run number, tables by name) that this run starts from."""
        if self._base is None:
            self._base = self.current()
        return self._base

    def load(self):
        """The state tables this run starts from; empty ones before the first run."""
        tables = self.base()[1]
        state = {
            name: self.read(tables[name]) if name in tables
            else self.spark.createDataFrame([], schema)
            for name, schema in STATE.items()
        }
        # A run leaves its last dead rows in the catalogue file; they are on
        # the dead-list already.
        state["catalog"] = state["catalog"].where(~is_dead())
        return state

    def status_counts(self):
        """(last_status, n) of the current catalogue, out of the log; no file of the catalogue is read.

        A catalogue committed without counts is scanned.
        """
        counts = self.base()[1].get("catalog", {}).get("counts")
        if counts is None or counts["column"] != STATUS:
            return status_counts(self.load()["catalog"])
        rows = self.spark.createDataFrame([tuple(r) for r in counts["rows"]], f"{STATUS} string, n bigint")
        return rows.where(~is_dead())

    def commit(self, entries, now):
        """Make the tables current, or raise CommitConflict."""
        run, tables = self.base()
        kept = {name: {k: v for k, v in entry.items() if k != "table"}
                for name, entry in {**tables, **entries}.items()}
        if not self._put(f"{self.root}/log", f"{run + 1:012d}.json", {"at": int(now), "tables": kept}):
            raise CommitConflict(f"run {run + 1} is there already; begin again")
        self._base = (run + 1, kept)
        return run + 1

    def expire_runs(self, keep=2):
        """Remove log files and tables of all but the newest runs; returns how many runs went.

        Folders of runs that died go too, once the state they began with is not the newest any more.
        """
        if keep < 1:
            raise ValueError("keep at least the newest run")
        log = self._log()
        numbers = sorted(log)
        old, kept = numbers[:-keep], numbers[-keep:]
        paths = lambda runs: {e["path"] for n in runs for e in self._entry(log[n])["tables"].values() if "path" in e}
        used = paths(kept)
        files, _ = self._files()
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        folders = {p.rsplit("/", 1)[0] for p in paths(old)} - {p.rsplit("/", 1)[0] for p in used}
        for path in [*folders, *(paths(old) - used), *self._orphans(max(numbers, default=0), used)]:
            files.delete(Path(path), True)
        for n in old:
            files.delete(Path(log[n]), False)
        return len(old)

    def _orphans(self, newest, used):
        """Folders of runs that can never commit, and whose tables no kept run uses."""
        files, _ = self._files()
        runs = self._path(f"{self.root}/runs")
        names = [s.getPath().getName() for s in files.listStatus(runs)] if files.exists(runs) else []
        begun = {n: int(m.group(1)) for n in names if (m := re.match(r"(\d{12})-", n))}
        in_use = {p.rsplit("/", 2)[-2] for p in used}
        return [f"{self.root}/runs/{n}" for n, base in begun.items() if base < newest and n not in in_use]

    def _name(self):
        name = f"endpulse_{uuid.uuid4().hex}"
        self._registered.append(name)
        return name

    def close(self):
        """Forget the table names; the files stay."""
        for name in self._registered:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: only the name goes
        self._registered = []
