import random

import pytest
from pyspark.sql import functions as F

from endpulse.operators import attempts
from endpulse.sources.snapshots import SnapshotStore
from endpulse.streaming import attempts as stream

SCHEMA = "proxy_hash string, attempt_seq long, ok boolean, latency_ms double"
NOW = 1_700_000_000


def tries(n, seed=1):
    """Attempts of 11 tests; one of them holds half of all."""
    rand = random.Random(seed)
    return [(f"h{i % 11 if i % 2 else 0}", i, rand.random() < .3, rand.choice([None, 5.0, float(i)])) for i in range(n)]


def text(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def place(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    landed, folder = str(tmp_path / "landed"), str(tmp_path / "first")

    def land(rows, checkpoint="check"):
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
        stream.start_attempts_stream(source, folder, str(tmp_path / checkpoint)).awaitTermination()

    so_far = lambda: stream.attempts_so_far(store, folder, schema)
    yield store, folder, schema, land, so_far
    store.close()


def test_split_late_and_replayed_batches_equal_the_batch(spark, place, tmp_path):
    store, folder, schema, land, so_far = place
    rows = tries(400)
    want = text(attempts.url_outcomes(spark.createDataFrame(rows, SCHEMA)))
    random.Random(2).shuffle(rows)  # first attempts come late
    assert so_far().count() == 0
    for i in range(0, 400, 100):
        land(rows[i:i + 100])
    assert len(list((tmp_path / "first").glob("batch=*"))) == 4
    assert text(attempts.url_outcomes(so_far())) == want
    land(rows[:50])  # rows that come twice count once
    land([], "another")  # a stream that lost its checkpoint replays all under names of its own
    assert text(attempts.url_outcomes(so_far())) == want
    assert so_far().groupBy("proxy_hash").count().agg(F.max("count")).first()[0] == attempts.ATTEMPTS


def test_compaction_keeps_what_lands_meanwhile_and_old_batches_change_nothing(spark, place, monkeypatch):
    store, folder, schema, land, so_far = place
    rows = tries(300, 3)
    land(rows[100:200])
    stream.compact(store, folder, schema, NOW)
    land(rows[:100])  # earlier attempts after the compaction
    write = store.write

    def meanwhile(*args, **how):
        monkeypatch.setattr(store, "write", write)
        land(rows[200:])
        return write(*args, **how)

    monkeypatch.setattr(store, "write", meanwhile)
    stream.compact(store, folder, schema, NOW)
    want = text(attempts.url_outcomes(spark.createDataFrame(rows, SCHEMA)))
    assert text(attempts.url_outcomes(so_far())) == want
    marks = stream.stored_attempts(store, folder)[1]
    assert list(marks.values()) == [1]
    assert stream.expire_batches(store, folder) == 2
    assert text(attempts.url_outcomes(so_far())) == want
    # New data of a stream without its checkpoint has low numbers again, and counts.
    land([("new", 1, True, 7.0)], "another")
    assert ("new", 1, True, "ok", 7.0) in {tuple(r) for r in attempts.url_outcomes(so_far()).collect()}


def test_a_conflict_starts_the_compaction_again(spark, place, tmp_path):
    store, folder, schema, land, so_far = place
    land(tries(60))
    other = SnapshotStore(spark, str(tmp_path / "state"))
    begin, calls = store.begin, []

    def begun(*key):
        place = begin(*key)
        if not calls:
            calls.append(other.begin())
            other.commit({}, NOW)
        return place

    store.begin = begun
    assert stream.compact(store, folder, schema, NOW) == 2
    assert text(so_far()) == text(stream.first_attempts(spark.createDataFrame(tries(60), SCHEMA)))


def test_tests_that_are_done_leave_the_state_and_old_runs_expire(spark, place):
    store, folder, schema, land, so_far = place
    rows = tries(90, 5)
    land(rows)
    stream.compact(store, folder, schema, NOW)
    done = spark.createDataFrame([("h0",), ("h0",), ("unheard",)], "proxy_hash string")
    stream.compact(store, folder, schema, NOW, done=done)
    kept = text(so_far())
    assert {r.proxy_hash for r in so_far().collect()} == {r[0] for r in rows} - {"h0"}
    store.begin()
    assert store.expire_runs(keep=1) == 1
    assert text(so_far()) == kept


def test_of_rows_with_one_number_the_least_counts(spark):
    rows = [("a", 1, True, 9.0), ("a", 1, True, 8.0), ("a", 1, True, None), ("a", 2, False, None), (None, 1, False, None)]
    for order in (rows, rows[::-1]):
        got = stream.first_attempts(spark.createDataFrame(order, SCHEMA)).collect()
        assert {tuple(r) for r in got} == {("a", 1, True, None), ("a", 2, False, None), (None, 1, False, None)}


def test_one_shuffle(spark):
    rows = spark.createDataFrame(tries(50), SCHEMA)
    plan = stream.first_attempts(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2
