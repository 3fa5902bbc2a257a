import base64
import hashlib
import urllib.parse

from pyspark.sql import functions as F

from endpulse import schemas
from endpulse.operators import ingest
from endpulse.sources.tables import read_converted, read_geo_networks, read_payloads


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


PAYLOADS = {
    "https://a.example/x?y=1": b"ss://one#l1\r\nnot a link\n ss://two \xff\n#only://x\x1css://one#l2",
    "https://b.example/": base64.urlsafe_b64encode("ss://one\nvless://three?é=>>>".encode()).rstrip(b"="),
    "https://c.example/": b"nothing here",
    "https://d.example/": b"",
}


def payloads(spark):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in PAYLOADS.items()], schemas.PAYLOADS)


def test_payload_links(spark):
    got = sorted((r.source, r.line) for r in ingest.payload_links(payloads(spark)).collect())
    a, b = list(PAYLOADS)[:2]
    assert got == sorted([(a, "ss://one#l1"), (a, "ss://two"), (a, "#only://x"), (a, "ss://one#l2"),
                          (b, "ss://one"), (b, "vless://three?é=>>>")])
    lines = ingest.payload_lines(payloads(spark)).where(F.col("line").isNull())
    assert sorted(r.source for r in lines.collect()) == list(PAYLOADS)[2:]


def test_payload_files(spark, tmp_path):
    for source, content in PAYLOADS.items():
        (tmp_path / urllib.parse.quote(source, safe="")).write_bytes(content)
    got = {r.source: bytes(r.content) for r in read_payloads(spark, str(tmp_path)).collect()}
    # Spark lists no empty files.
    assert got == {source: content for source, content in PAYLOADS.items() if content}


def test_changed_sources_and_state(spark):
    a, b, c, d = PAYLOADS
    state = spark.createDataFrame([(a, sha(PAYLOADS[a])), (b, "stale"), ("unseen", "kept")], schemas.SOURCE_STATE)
    changed = ingest.changed_sources(payloads(spark), state)
    assert {r.source for r in changed.collect()} == {b, c, d}
    after = ingest.upsert_source_state(state, changed.select("source", "data_hash"))
    assert {r.link: r.last_data_hash for r in after.collect()} == {
        "unseen": "kept", **{s: sha(content) for s, content in PAYLOADS.items()}}


def test_candidates_and_counts(spark):
    converted = spark.createDataFrame(
        [("ss://one", '{"protocol":"ss"}'), ("ss://two", None), ("vless://three?é=>>>", '{"protocol":"vless"}'),
         ("ss://unused", '{"protocol":"ss"}'), ("ss://noproto", "{}")], schemas.CONVERTED)
    links = ingest.clean_links(ingest.payload_links(payloads(spark)))
    known = ingest.known_links(converted)
    got = sorted(tuple(r) for r in ingest.fresh_candidates(links, known).collect())
    assert got == sorted([(sha("ss://one"), "ss://one", "ss"),
                          (sha("vless://three?é=>>>"), "vless://three?é=>>>", "vless")])
    facts = ingest.outbound_facts(converted)
    assert sorted(tuple(r) for r in ingest.fresh_candidates(links, facts).collect()) == got
    stats = {r.source: tuple(r)[1:] for r in ingest.ingest_stats(ingest.link_counts(links), known).collect()}
    a, b = list(PAYLOADS)[:2]
    assert stats == {a: (3, 2, 1), b: (2, 2, 2)}
    dead = spark.createDataFrame([(sha("ss://one"), "", "", "", 0, 0)], schemas.DEAD)
    total = ingest.ingest_totals(ingest.link_counts(links), known, dead).collect()[0]
    assert tuple(total) == (5, 4, 2, 1, 1)


def test_stage_fresh_drops_nulls_and_repeats(spark):
    rows = spark.createDataFrame([("a", "l", "s"), ("a", "l", "s"), ("b", None, "s"), (None, "l", "s")], schemas.FRESH)
    assert [tuple(r) for r in ingest.stage_fresh(rows).collect()] == [("a", "l", "s")]


def test_one_link_with_most_rows(spark):
    lines = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "src0").otherwise(F.concat(F.lit("src"), F.col("id") % 50)).alias("source"),
        F.when(F.col("id") % 2 == 0, "ss://hot").otherwise(F.concat(F.lit("ss://l"), F.col("id"))).alias("line"))
    links = ingest.clean_links(lines)
    assert ingest.distinct_links(links).count() == 30001
    plan = ingest.distinct_links(links)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_missing_tables_are_empty(spark, tmp_path):
    assert read_converted(spark, str(tmp_path / "none")).count() == 0
    assert read_geo_networks(spark, str(tmp_path / "none")).schema == schemas.GEO_NETWORKS
