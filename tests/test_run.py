"""Whole runs over several days, checked against a plain restatement."""

import json
import random

import pytest
from pyspark.sql import functions as F

from endpulse import schemas
from endpulse.operators import containment
from endpulse.plans.run_once import Inputs, Params, run_once
from endpulse.sources.export import ExportOptions
from endpulse.sources.snapshots import SnapshotStore

NOW = 1700000000
DAY = 86400
OBSERVED = "proxy_hash string, attempt_seq long, ok boolean, "


def link(i):
    return f"vless://id{i}@h{i % 7}.example:443"


def config(i):
    if i % 11 == 0:
        return None
    stream = {"network": "xhttp", "xhttpSettings": {"host": "a@b" if i % 13 == 0 else "h"}}
    address = {} if i % 17 == 0 else {"address": f"h{i % 7}.example"}
    return json.dumps({"protocol": "vless", "settings": {"vnext": [address]}, "streamSettings": stream})


def sha(text):
    import hashlib
    return hashlib.sha256(text.encode()).hexdigest()


def inputs(spark, bodies, seed, n=60):
    rng = random.Random(seed)
    known = [sha(link(i)) for i in range(n)]
    url, answers, speed = [], [], []
    for i, h in enumerate(known):
        for k in range(rng.randrange(0, 5)):
            url.append((h, i * 10 + k, rng.random() < 0.7, float(rng.randrange(1, 500))))
            answers.append((h, i * 10 + k, rng.random() < 0.8, rng.choice(["1.2.3.4", "9.9.9.9", " ", "8.8.8.8"])))
            speed.append((h, i * 10 + k, rng.random() < 0.8, rng.randrange(10**7), rng.choice([0.0, 1.0, 2.0])))
    return Inputs(
        payloads=spark.createDataFrame([(k, bytearray(v.encode())) for k, v in bodies.items()], schemas.PAYLOADS),
        converted=spark.createDataFrame([(link(i), config(i)) for i in range(n)], schemas.CONVERTED),
        url_attempts=spark.createDataFrame(url, OBSERVED + "latency_ms double"),
        exit_answers=spark.createDataFrame(answers, "proxy_hash string, answer_seq long, ok boolean, body string"),
        speed_attempts=spark.createDataFrame(speed, OBSERVED + "n_bytes long, duration_s double"),
        resolutions=spark.createDataFrame([(f"h{i}.example", f"10.{i}.0.1") for i in range(6)], schemas.RESOLUTIONS),
        networks=containment.parse_networks(spark.createDataFrame([("10.3.0.0/16",)], "line string")),
        geo=spark.createDataFrame([("1.0.0.0/8", "DE", "Germany", "Berlin"), ("9.0.0.0/8", "", "Nowhere", None)],
                                  schemas.GEO_NETWORKS))


def bodies(*numbers):
    return "\n".join(f"{link(i)}#label {i}" for i in numbers)


def params(now, **more):
    return Params(now=now, target=5, ttl_days=1, cidr_method="exclude", country_method="exclude",
                  countries=("nowhere",), elapsed=61.0, **more)


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("state"))
    out = root + "/out"
    feeds = {"s1": bodies(*range(0, 40)), "s2": bodies(*range(30, 60))}
    first_inputs = inputs(spark, feeds, 1)
    first = run_once(spark, root, first_inputs, params(NOW), out + "/1")
    first = {**first, **{k: first[k].collect() for k in ("catalog", "dead", "selected", "sources", "totals")}}
    feeds["s2"] = bodies(*range(30, 60), 1)
    second = run_once(spark, root, inputs(spark, feeds, 2), params(NOW + DAY), out + "/2")
    second = {**second, **{k: second[k].collect() for k in ("catalog", "dead", "selected", "sources", "totals")}}
    return root, first, second


def test_first_run_adds_what_the_converter_knows(two_runs):
    _, first, _ = two_runs
    unique = {i for i in range(60) if i % 11}
    total = first["totals"][0]
    assert (total.total_links, total.unique_fresh, total.added, total.skipped_dead) == (70, len(unique), len(unique), 0)
    assert len(first["catalog"]) + len(first["dead"]) == len(unique)
    assert first["run"] == 1


def test_invariants(two_runs):
    _, first, second = two_runs
    for run in (first, second):
        alive, dead = ({r.proxy_hash for r in run[n]} for n in ("catalog", "dead"))
        assert not alive & dead
        fast = {r.proxy_hash for r in run["catalog"] if r.last_status == "speed_ok"}
        assert {r.proxy_hash for r in run["selected"]} <= fast and len(run["selected"]) <= 5
        assert run["selected"] and all(r.last_status in ("url_ok", "speed_ok", "unknown") for r in run["catalog"])
        # Country lists are in capitals, so a name out of the geo table never matches one.
        assert {r.country for r in run["catalog"]} <= {"DE", "Nowhere"}


def test_reasons_of_the_dead(two_runs):
    _, first, _ = two_runs
    reasons = {r.proxy_hash: r.reason for r in first["dead"]}
    for i in range(60):
        if i % 11 and i % 7 in (3, 6) and i % 17:
            assert reasons[sha(link(i))] == "cidr_discarded"
        elif i % 11 and i % 17 and i % 13 == 0:
            assert reasons[sha(link(i))] == "invalid_proxy_uri"


def test_second_run(two_runs):
    _, first, second = two_runs
    # s1 did not change, so only s2's lines are counted; one of them is new to it.
    assert second["totals"][0].total_links == 31
    gone = {r.proxy_hash for r in first["dead"]}
    kept = {r.proxy_hash for r in second["dead"]}
    # Entries end exactly now, so they are still there and bar the way.
    assert gone <= kept
    assert {r.proxy_hash: r.created_at for r in second["dead"] if r.proxy_hash in gone} == {
        r.proxy_hash: r.created_at for r in first["dead"]}
    old = {r.proxy_hash: r for r in first["catalog"]}
    for r in second["catalog"]:
        if r.proxy_hash in old:
            assert r.first_seen_at == NOW
            if old[r.proxy_hash].mbps is not None:
                assert r.mbps is not None
    assert second["run"] == 2 and len(second["sources"]) == 2


def test_same_inputs_again_add_nothing(spark, two_runs):
    root, _, second = two_runs
    feeds = {"s1": bodies(*range(0, 40)), "s2": bodies(*range(30, 60), 1)}
    third = run_once(spark, root, inputs(spark, feeds, 2), params(NOW + DAY))
    assert third["totals"].collect()[0].total_links == 0
    assert {r.proxy_hash for r in third["catalog"].collect()} <= {r.proxy_hash for r in second["catalog"]}


def test_export(two_runs, spark):
    root, first, _ = two_runs
    text = "".join(p.read_text() for p in sorted(__import__("pathlib").Path(root, "out", "1").glob("part-*")))
    lines = text.split("\n")
    assert lines[0].startswith("#profile-title: base64:") and text.endswith("\n")
    assert "# Time elapsed: 00:01:01" in lines and f"# Count: {len(first['selected'])}" in lines
    assert f"# Candidates processed: {first['candidates']}" in lines
    links = [x for x in lines if "://" in x]
    by_hash = sorted(first["selected"], key=lambda r: r.proxy_hash)
    assert [x.split("#")[0] for x in links] == [r.raw_link for r in by_hash]


def test_export_order_and_separate_headers(spark, tmp_path):
    from endpulse.sources.export import write_export
    rows = [(h, NOW, f"ss://{h}", None, m, None, None, None) for h, m in (("a", 1.0), ("b", 3.0), ("c", None))]
    chosen = spark.createDataFrame(rows, schemas.SELECTED)
    options = ExportOptions(order="mbps", separate_headers=True)
    write_export(chosen, options, NOW, str(tmp_path / "x"), headers_path=str(tmp_path / "h"))
    read = lambda n: "".join(p.read_text() for p in (tmp_path / n).glob("part-*")).splitlines()
    assert [x.split("#")[0] for x in read("x")[3:]] == ["ss://b", "ss://a", "ss://c"]
    assert len(read("x")) == 6 and not any("Stats" in x for x in read("x"))
    assert read("h")[1] == 'add_header profile-update-interval "24";'


def test_state_after_conversion(spark, tmp_path):
    feeds = {"known": bodies(1, 2), "unknown": "vless://not-converted"}
    data = inputs(spark, feeds, 3)
    run = run_once(spark, str(tmp_path), data, Params(now=NOW, commit_state="after"))
    assert {r.link for r in run["sources"].collect()} == {"known"}
    again = run_once(spark, str(tmp_path), data, Params(now=NOW))
    assert again["totals"].collect()[0].total_links == 1
    assert {r.link for r in again["sources"].collect()} == {"known", "unknown"}


def test_stored_tables_are_joined_without_shuffling_them(spark, tmp_path):
    from endpulse.operators import catalog as cat
    store = SnapshotStore(spark, str(tmp_path))
    table = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("proxy_hash"),
                                     *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.CATALOG.fields[1:]])
    stored = store.read(store.write(table, store.begin(), "catalog"))
    dead = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("proxy_hash"),
                                   *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.DEAD.fields[1:]])
    buried = store.read(store.write(dead, store.begin(), "dead"))
    fresh = spark.range(300, 1300).select(F.sha2(F.col("id").cast("string"), 256).alias("proxy_hash"),
                                          F.lit("l").alias("raw_link"), F.lit("s").alias("scheme"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = cat.merge_candidates(stored, fresh, buried, NOW)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan  # only the fresh rows
        assert merged.count() == 1300
        assert merged.where("last_seen_at is not null").count() == 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        store.close()


def test_stages_shuffle_neither_catalogue_nor_facts(spark, tmp_path):
    from endpulse.operators import catalog as cat
    from endpulse.plans import stages

    store = SnapshotStore(spark, str(tmp_path))
    ids = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("proxy_hash"))
    blank = lambda f: F.lit(None).cast(f.dataType).alias(f.name)
    table = store.read(store.write(ids.select("*", *map(blank, schemas.CATALOG.fields[1:])), store.begin(),
                                   "catalog", spread=True))
    facts = store.read(store.write(ids.select("*", F.lit("h").alias("host"), F.lit("safe").alias("verdict")),
                                   store.begin(), "facts", spread=True))
    tries = spark.range(8000).select(
        F.sha2((F.col("id") % 1500).cast("string"), 256).alias("proxy_hash"), F.col("id").alias("attempt_seq"),
        (F.col("id") > 1000).alias("ok"), F.lit(1.0).alias("latency_ms"))
    exits = store.read(store.write(ids.withColumn("exit_ip", F.lit("1.2.3.4")), store.begin(), "exits", spread=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results = stages.url_stage(table, facts, tries, stages.exit_places(exits))
        tested = cat.update_catalog(table, stages.outcomes(results), NOW)
        plan = tested._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan  # only the attempts
        assert {r.last_status: r["count"] for r in tested.groupBy("last_status").count().collect()} == {
            "url_ok": 1500, "dead": 500}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        store.close()


def test_a_new_session_finds_the_tables(spark, two_runs):
    root, _, second = two_runs
    store = SnapshotStore(spark, root)
    state = store.load()
    assert store.current()[0] >= 2
    assert state["catalog"].count() > 0 and state["dead"].count() >= len(second["dead"])
    store.close()


def test_nothing_becomes_current_before_the_end(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.write(spark.createDataFrame([], schemas.CATALOG), store.begin(), "catalog")
    assert store.current() == (0, {})
    assert store.load()["catalog"].count() == 0
    store.close()


def test_a_run_without_burials_leaves_the_stored_dead_list(spark, tmp_path):
    root = str(tmp_path)
    store = SnapshotStore(spark, root)
    rows = [(sha(link(i)), link(i), "vless", "ok", NOW - DAY, NOW + (5 if i < 3 else -5)) for i in (1, 2, 3)]
    entry = store.write(spark.createDataFrame(rows, schemas.DEAD), store.begin(), "dead")
    store.commit({"dead": entry}, NOW - DAY)
    nothing = inputs(spark, {"s1": bodies(1, 2)}, 1)
    done = run_once(spark, root, nothing, params(NOW))  # both are on the dead-list
    assert {r.proxy_hash for r in done["dead"].collect()} == {sha(link(1)), sha(link(2))}
    assert done["figures"]["expired"] == 1 and done["catalog"].count() == 0
    tables = store.current()[1]
    assert tables["dead"]["path"] == entry["path"] and tables["catalog"]["path"] != entry["path"]
    done["store"].close()
    # A run with burials writes it again, without what is past its time, and the old one may go.
    done = run_once(spark, root, inputs(spark, {"s1": bodies(1, 2, 3)}, 1), params(NOW))
    assert {r.proxy_hash: r.reason for r in done["dead"].collect()} == {
        sha(link(1)): "ok", sha(link(2)): "ok", sha(link(3)): "cidr_discarded"}
    new = store.current()[1]["dead"]["path"]
    assert new != entry["path"] and spark.read.parquet(new).count() == 3
    store.begin()
    store.expire_runs(keep=1)
    assert spark.read.parquet(new).count() == 3
    done["store"].close()
    store.close()
