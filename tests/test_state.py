"""State that several writers and late results share, keys, and what is refused."""

import pytest
from pyspark.sql import functions as F

from endpulse import schemas
from endpulse.functions import export_text
from endpulse.operators import catalog as cat, containment, ingest
from endpulse.plans.run_once import Inputs, Params, run_once
from endpulse.sources.snapshots import CommitConflict, SnapshotStore
from endpulse.streaming import results as rs

from test_catalog import NOW, catalog


def result(spark, *rows):
    """(seq, hash, ok, latency)"""
    return spark.createDataFrame(
        [(s, h, "url", ok, "ok" if ok else "url_test_failed", ms, None, None, None, None) for s, h, ok, ms in rows],
        schemas.RESULTS)


def land(spark, folder, n, frame):
    cat.fold_results(frame).write.parquet(f"{folder}/batch={n}")


def status(frame):
    return {r.proxy_hash: (r.last_status, r.latency_ms) for r in frame.collect()}


@pytest.fixture
def store(spark, tmp_path):
    own = SnapshotStore(spark, str(tmp_path / "state"))
    base = catalog(spark, *[dict(proxy_hash=f"h{i}") for i in range(4)])
    own.commit({"catalog": own.write(base, own.begin(), "catalog")}, NOW)
    yield own
    own.close()


def put(store, **columns):
    frame = store.load()["catalog"].withColumns({k: F.lit(v) for k, v in columns.items()})
    return {"catalog": store.write(frame, f"{store.root}/runs/{columns['reason']}", "catalog")}


def test_of_two_writers_one_has_to_begin_again(spark, store):
    other = SnapshotStore(spark, store.root)
    store.begin(), other.begin()
    mine, theirs = put(store, reason="mine"), put(other, reason="theirs")
    assert store.commit(mine, NOW) == 2
    with pytest.raises(CommitConflict):
        other.commit(theirs, NOW)
    assert {r.reason for r in store.load()["catalog"].collect()} == {"mine"}
    other.begin()
    assert other.commit(put(other, reason="again"), NOW) == 3
    assert SnapshotStore(spark, store.root).current()[0] == 3
    assert store.current()[0] == 3 and store.base()[0] == 2  # a run reads what it began with
    other.close()


def test_a_run_does_not_undo_a_compaction(spark, store, tmp_path):
    folder = str(tmp_path / "folded")
    land(spark, folder, 0, result(spark, (5, "h1", True, 9.0)))
    late = SnapshotStore(spark, store.root)
    late.begin()
    stale = put(late, reason="stale")
    rs.compact(store, folder, NOW)
    with pytest.raises(CommitConflict):
        late.commit(stale, NOW)
    assert status(store.load()["catalog"])["h1"] == ("url_ok", 9.0)
    late.close()


def test_batches_during_a_compaction_stay_and_none_counts_twice(spark, store, tmp_path, monkeypatch):
    folder = str(tmp_path / "folded")
    land(spark, folder, 0, result(spark, (5, "h1", True, 9.0)))
    first = store.write

    def write(*args, **more):  # a batch lands while the compaction writes
        monkeypatch.setattr(store, "write", first)
        land(spark, folder, 1, result(spark, (6, "h2", True, 4.0)))
        return first(*args, **more)

    monkeypatch.setattr(store, "write", write)
    rs.compact(store, folder, NOW)
    assert status(store.load()["catalog"])["h2"] == ("unknown", None)
    applied, taken = rs.stream_state(store, folder)
    assert taken == ["batch=0"]
    now = status(rs.current_catalog(spark, store.load()["catalog"], folder, NOW, applied, taken))
    assert now["h1"] == ("url_ok", 9.0) and now["h2"] == ("url_ok", 4.0)
    store.begin()
    store.commit(put(store, reason="run", last_status="cidr_ok"), NOW)  # another run changes the state
    rs.compact(store, folder, NOW)
    done = status(store.load()["catalog"])
    assert done["h1"] == ("cidr_ok", 9.0) and done["h2"] == ("url_ok", 4.0)  # batch 0 is not applied again


def test_an_old_result_after_a_new_one_changes_nothing(spark, store, tmp_path):
    folder = str(tmp_path / "folded")
    land(spark, folder, 0, result(spark, (50, "h1", True, 9.0)))
    rs.compact(store, folder, NOW)
    land(spark, folder, 1, result(spark, (20, "h1", False, None), (60, "h2", True, 3.0), (10, "h1", True, 1.0)))
    rs.compact(store, folder, NOW)
    done = status(store.load()["catalog"])
    assert done["h1"] == ("url_ok", 9.0) and done["h2"] == ("url_ok", 3.0)


def test_unfinished_batches_are_not_read(spark, store, tmp_path):
    folder = tmp_path / "folded"
    land(spark, str(folder), 0, result(spark, (5, "h1", True, 9.0)))
    (folder / "batch=0" / "_SUCCESS").unlink()
    assert rs.batches(spark, str(folder)) == []


def test_old_runs_are_removed_and_the_newest_is_read(spark, store, tmp_path):
    for n in range(4):
        store.begin()
        store.commit(put(store, reason=f"r{n}"), NOW)
    folders = lambda: {p.name for p in (tmp_path / "state" / "runs").iterdir()}
    before = folders()
    assert store.expire_runs(keep=2) == 3
    assert folders() == {"r2", "r3"} < before
    fresh = SnapshotStore(spark, store.root)
    assert fresh.current()[0] == 5 and {r.reason for r in fresh.load()["catalog"].collect()} == {"r3"}
    assert store.expire_runs(keep=2) == 0
    with pytest.raises(ValueError):
        store.expire_runs(keep=0)
    fresh.close()


def payloads(spark, *rows):
    return spark.createDataFrame([(s, bytearray(b.encode()), t) for s, b, t in rows],
                                 "source string, content binary, arrived long")


def test_repeated_sources_keep_the_last_payload(spark):
    state = spark.createDataFrame([("a", "old")], schemas.SOURCE_STATE)
    rows = payloads(spark, ("a", "ss://1", 5), ("a", "ss://2", 9), ("a", "ss://3", 7), ("b", "ss://4", None))
    changed = ingest.changed_sources(rows, state)
    lines = ingest.changed_lines(rows, changed)
    assert sorted((r.source, r.line) for r in lines.collect()) == [("a", "ss://2"), ("b", "ss://4")]
    after = ingest.upsert_source_state(state, changed).collect()
    assert len(after) == 2 and all(len(r.last_data_hash) == 64 for r in after)
    twice = ingest.upsert_source_state(state, spark.createDataFrame([("a", "x"), ("a", "y")], "source string, data_hash string"))
    assert [tuple(r) for r in twice.collect()] == [("a", "y")]


def test_long_lists_of_changed_sources_give_the_same_lines(spark, monkeypatch):
    state = spark.createDataFrame([], schemas.SOURCE_STATE)
    rows = payloads(spark, *[(f"s{i}", f"ss://{i}\nss://{i % 3}", i) for i in range(20)])
    changed = ingest.changed_sources(rows, state).where("source <> 's3'")
    counts = lambda: sorted(map(str, ingest.changed_lines(rows, changed, then=lambda x: ingest.link_counts(
        ingest.hashed_links(x, "data_hash", "arrived"), "data_hash", "arrived")).collect()))
    few = counts()
    monkeypatch.setattr(ingest, "FEW_SOURCES", 5)
    assert counts() == few and len(few) == 35


def test_payload_bytes_are_in_no_shuffle(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = payloads(spark, *[(f"s{i}", "ss://x", i) for i in range(20)])
        state = spark.createDataFrame([("a", "old")], schemas.SOURCE_STATE)
        changed = ingest.changed_sources(rows, state)
        then = lambda x: ingest.link_counts(ingest.hashed_links(x, "data_hash", "arrived"), "data_hash", "arrived")
        for limit in (100, 1):
            monkeypatch.setattr(ingest, "FEW_SOURCES", limit)
            for frame in (changed, ingest.changed_lines(rows, changed, then=then)):
                plan = frame._jdf.queryExecution().executedPlan()
                below = []

                def walk(node):
                    if "ShuffleExchange" in node.getClass().getSimpleName():
                        below.append(str(node.child().output().mkString(",")))
                    for i in range(node.children().size()):
                        walk(node.children().apply(i))

                walk(plan.executedPlan())
                assert below and not any("content" in columns or "plain_text" in columns for columns in below)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_links_are_one_candidate(spark):
    converted = spark.createDataFrame(
        [("ss://1", '{"protocol":"ss"}'), ("ss://1", '{"protocol":"ss"}'), ("ss://1", None), ("ss://2", None)], schemas.CONVERTED)
    assert ingest.known_links(converted).count() == 1
    facts = {r.raw_link: r.verdict for r in ingest.outbound_facts(converted).collect()}
    assert facts == {"ss://1": "safe", "ss://2": "missing"}
    links = ingest.clean_links(spark.createDataFrame([("a", "ss://1"), ("b", "ss://1")], "source string, line string"))
    assert ingest.fresh_candidates(links, ingest.known_links(converted)).count() == 1


@pytest.mark.parametrize("wrong", [
    dict(cidr_method="Exclude"), dict(country_method="only"), dict(commit_state="later"), dict(target=0),
    dict(max_attempts=0), dict(ttl_days=-1)])
def test_parameters_are_checked(wrong):
    with pytest.raises(ValueError):
        Params(now=NOW, **wrong)


def test_methods_are_a_closed_set(spark, tmp_path):
    frame = catalog(spark, dict(proxy_hash="a"))
    with pytest.raises(ValueError):
        cat.country_filter(frame, ["DE"], "Exclude")
    with pytest.raises(ValueError):
        containment.host_verdicts(None, None, "none")
    with pytest.raises(ValueError):
        run_once(spark, str(tmp_path), Inputs(None, None, None, None, None), Params(now=NOW, cidr_method="include"))


def test_times_are_utc_in_any_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = spark.createDataFrame([(1700000000,), (0,), (951782399,)], "t long").select(
            export_text.iso_utc(F.col("t")), export_text.spoken_time(F.col("t"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in row] == [
        ("2023-11-14T22:13:20+00:00", "22:13:20 14.11.2023"), ("1970-01-01T00:00:00+00:00", "00:00:00 01.01.1970"),
        ("2000-02-28T23:59:59+00:00", "23:59:59 28.02.2000")]


def test_counts_come_out_of_the_log_and_agree_with_a_scan(spark, store, tmp_path):
    counted = lambda s: {r.last_status: r.n for r in s.status_counts().collect()}
    scanned = lambda s: {r.last_status: r.n for r in cat.status_counts(s.load()["catalog"]).collect()}
    assert counted(store) == scanned(store)  # committed without counts
    folder = str(tmp_path / "folded")
    for n, (name, ok) in enumerate([("h1", True), ("h2", False), ("h3", True)]):
        land(spark, folder, n, result(spark, (5 + n, name, ok, 9.0)))
        rs.compact(store, folder, NOW + n)
        assert counted(store) == scanned(store)
        assert store.status_counts().inputFiles() == []
    assert counted(store)["url_ok"] == 2 and "dead" not in counted(store)
    empty = SnapshotStore(spark, str(tmp_path / "none"))
    assert counted(empty) == {}
