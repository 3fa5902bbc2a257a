"""The registered queries, each reading whole tables.

Fixture views stand for the pipeline's own tables; see FIXTURES.md.
"""

from dataclasses import replace

from pyspark.sql import functions as F

from endpulse.functions.durations import duration_seconds
from endpulse.functions.outbound import SAFE, with_facts, with_host, with_verdict
from endpulse.functions.text import with_base64_text
from endpulse.operators import attempts, catalog as cat, containment, ingest, select
from endpulse.plans import stages
from endpulse.plans.run_once import Inputs, Params, run_once
from endpulse.schemas import CATALOG, RESULTS
from endpulse.session import shared_folder
from endpulse.sources.export import ExportOptions, banner_rows, header_rows, link_rows, write_export
from endpulse.sources import pages
from endpulse.sources.snapshots import SnapshotStore
from endpulse.sources.tables import network_lines
from endpulse.streaming import attempts as attempt_stream, changed, results as result_stream

from .fixtures import NOW, view

TOP_N = 25
COUNTRIES = ("bh", " CO ", "DV", "")
EXPORT = ExportOptions(title="Top endpoints of the day, sorted out by the whole pipeline",
                       web_page_url="https://pages.example/list")
COUNT_PARAMS = {"elapsed": 3725.9, "candidates": 1234}

CHANGED_SOURCES = ("src0", "src2")
NOW_2 = NOW + 86400
DNS_TTL = 600

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


class _Views:
    """Fixture views by name: ``v.catalog``."""

    def __init__(self, spark, sf_dir):
        self._at = (spark, sf_dir)

    def __getattr__(self, name):
        return view(*self._at, name)

    @property
    def content(self):
        return self.payloads.select("source", F.encode("body", "UTF-8").alias("content"))

    @property
    def links(self):
        return ingest.clean_links(ingest.link_lines(self.raw_lines))

    @property
    def counts(self):
        return self.stored(ingest.link_counts(self.links))

    @property
    def known(self):
        return ingest.known_links(self.outbounds)

    @property
    def parsed_networks(self):
        return containment.parse_networks(network_lines(self.cidr_lines))

    # Tables that a stage finds stored.

    @property
    def networks(self):
        return self.stored(self.parsed_networks)

    @property
    def geo(self):
        return self.stored(containment.geo_networks(self.geo_networks))

    @property
    def facts(self):
        return self.stored(ingest.outbound_facts(self.outbounds), bucketed=True, spread=True)

    @property
    def page_catalog(self):
        """A catalogue of the pages' links, as a merge into an empty one leaves it."""
        empty = self._at[0].createDataFrame([], CATALOG)
        return self.stored(cat.merge_candidates(
            empty, ingest.fresh_candidates(self.links, self.known), self.dead, NOW), bucketed=True)

    def stored(self, df, bucketed=False, spread=False):
        store = SnapshotStore(self._at[0], shared_folder(self._at[0], "tables"))
        return store.read(store.write(df, store.root, "table", bucketed, spread))


# Scans ---------------------------------------------------------------------

@query
def load_state(spark, sf_dir):
    return _Views(spark, sf_dir).catalog


@query
def selected_scan(spark, sf_dir):
    top = select.select_top(_Views(spark, sf_dir).catalog, TOP_N, NOW)
    return top.select("proxy_hash", "raw_link", F.coalesce("country", F.lit("?")).alias("country"))


@query
def parse_networks(spark, sf_dir):
    nets = _Views(spark, sf_dir).parsed_networks
    return nets.select("line", "version", "prefix_len", "p_hi")


@query
def rejected_networks(spark, sf_dir):
    lines = network_lines(_Views(spark, sf_dir).cidr_lines)
    return containment.rejected_networks(lines).select("line")


# Ingest --------------------------------------------------------------------

@query
def distinct_links(spark, sf_dir):
    return ingest.distinct_links(_Views(spark, sf_dir).links)


@query
def split_payload_links(spark, sf_dir):
    return ingest.payload_links(_Views(spark, sf_dir).content)


@query
def decode_base64_payload(spark, sf_dir):
    encoded = _Views(spark, sf_dir).payloads.where(~F.col("body").contains("://"))
    return with_base64_text(encoded, "body", "decoded").select("source", "decoded")


@query
def changed_sources(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return ingest.changed_sources(v.content, v.source_state).select("source", "data_hash")


@query
def source_state_upsert(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return ingest.upsert_source_state(v.source_state, ingest.payload_hash(v.content))


@query
def fresh_candidates(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return ingest.fresh_candidates(v.links, v.known)


@query
def stage_fresh(spark, sf_dir):
    v = _Views(spark, sf_dir)
    rows = v.links.join(v.known.select("proxy_hash", "scheme"), "proxy_hash", "left")
    return ingest.stage_fresh(rows.withColumnRenamed("link", "raw_link"))


@query
def ingest_stats(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return ingest.ingest_stats(v.counts, v.known)


@query
def ingest_totals(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return ingest.ingest_totals(v.counts, v.known, v.dead)


# Catalogue and dead-list ---------------------------------------------------

@query
def expire_dead(spark, sf_dir):
    return cat.expire_dead(_Views(spark, sf_dir).dead, NOW)


@query
def merge_candidates(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return cat.merge_candidates(v.existing, v.fresh, cat.expire_dead(v.dead, NOW), NOW)


@query
def merge_count(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return cat.living(v.fresh, cat.expire_dead(v.dead, NOW)).agg(F.count("*").alias("added"))


@query
def apply_results(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return cat.apply_results(v.catalog, v.results, NOW)


@query
def move_dead_catalog(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return cat.move_dead(v.catalog, v.dead, NOW)[0]


@query
def move_dead_deadlist(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return cat.move_dead(v.catalog, v.dead, NOW)[1]


@query
def status_counts(spark, sf_dir):
    return cat.status_counts(_Views(spark, sf_dir).catalog)


def _country(spark, sf_dir, countries, method):
    marked = cat.country_filter(_Views(spark, sf_dir).catalog, countries, method)
    return marked.select("proxy_hash", "country", "last_status", "reason")


@query
def country_filter_exclude(spark, sf_dir):
    return _country(spark, sf_dir, COUNTRIES, "exclude")


@query
def country_filter_include(spark, sf_dir):
    return _country(spark, sf_dir, COUNTRIES, "include")


@query
def country_filter_empty_list(spark, sf_dir):
    return _country(spark, sf_dir, (), "exclude")


@query
def country_filter_include_empty_list(spark, sf_dir):
    return _country(spark, sf_dir, (), "include")


# Networks ------------------------------------------------------------------

@query
def resolve_hosts(spark, sf_dir):
    v = _Views(spark, sf_dir)
    hosts = with_host(v.outbounds).where(F.col("host").isNotNull())
    return containment.resolve_hosts(hosts, v.resolutions)


@query
def resolve_hosts_as_of(spark, sf_dir):
    v = _Views(spark, sf_dir)
    hosts = with_host(v.outbounds).where(F.col("host").isNotNull())
    return containment.resolve_hosts_as_of(hosts, v.stored(v.lookups), NOW, DNS_TTL)


def _cidr(spark, sf_dir, method):
    v = _Views(spark, sf_dir)
    pairs = v.stored(containment.resolve_hosts(v.resolutions.select("host"), v.resolutions))
    return containment.host_verdicts(pairs, v.networks, method)


@query
def cidr_include(spark, sf_dir):
    return _cidr(spark, sf_dir, "include")


@query
def cidr_exclude(spark, sf_dir):
    return _cidr(spark, sf_dir, "exclude")


@query
def address_in_networks(spark, sf_dir):
    v = _Views(spark, sf_dir)
    return containment.contained(v.catalog.select(F.col("exit_ip").alias("address")), v.networks)


@query
def geo_lookup(spark, sf_dir):
    v = _Views(spark, sf_dir)
    rows = v.catalog.select("proxy_hash", "exit_ip")
    return containment.with_geo(rows, v.geo, "proxy_hash")


# Test attempts -------------------------------------------------------------

@query
def url_first_success(spark, sf_dir):
    return attempts.url_outcomes(_Views(spark, sf_dir).attempts, "test_id")


@query
def url_elapsed_latency(spark, sf_dir):
    timed = _Views(spark, sf_dir).attempts.withColumn(
        "latency_ms", F.when(F.col("ok"), attempts.latency_ms(F.col("duration_s"))))
    return attempts.url_outcomes(timed, "test_id").select("test_id", "success", "latency_ms")


@query
def speed_first_success(spark, sf_dir):
    return attempts.speed_outcomes(_Views(spark, sf_dir).attempts, "test_id", 50.0)


@query
def attempt_bytes(spark, sf_dir):
    return attempts.attempt_bytes(_Views(spark, sf_dir).attempts, "test_id")


@query
def exit_ip_first_answer(spark, sf_dir):
    return attempts.exit_ips(_Views(spark, sf_dir).exit_answers, "test_id")


@query
def speed_early_stop(spark, sf_dir):
    speeds = _Views(spark, sf_dir).results.where("kind = 'speed'")
    return attempts.early_stop(speeds.withColumn("success", F.col("mbps") > 20), 40)


@query
def speed_early_stop_half(spark, sf_dir):
    """Half of all successes are wanted, and no task sorts more than 100 of them."""
    v = _Views(spark, sf_dir)
    speeds = v.stored(v.results.where("kind = 'speed'").withColumn("success", F.col("mbps") > 20))
    half = speeds.where("success").count() // 2 + 1
    return attempts.early_stop(speeds, half, task_rows=100)


@query
def success_count(spark, sf_dir):
    speeds = _Views(spark, sf_dir).results.where("kind = 'speed'")
    kept = attempts.early_stop(speeds.withColumn("success", F.col("mbps") > 20), 40)
    return kept.agg(F.count_if("success").alias("successes"), F.count("*").alias("tests"))


# Configurations ------------------------------------------------------------

@query
def safe_outbounds(spark, sf_dir):
    return with_verdict(_Views(spark, sf_dir).outbounds).where(F.col("verdict") == SAFE).select("link")


@query
def outbound_host(spark, sf_dir):
    return with_host(_Views(spark, sf_dir).outbounds).select("link", "host")


@query
def outbound_facts(spark, sf_dir):
    return with_facts(_Views(spark, sf_dir).outbounds).select("link", "scheme", "host", "verdict")


@query
def duration_texts(spark, sf_dir):
    texts = _Views(spark, sf_dir).durations
    return texts.select("id", duration_seconds(F.col("txt")).alias("seconds"))


# Stages --------------------------------------------------------------------

@query
def cidr_stage(spark, sf_dir):
    v = _Views(spark, sf_dir)
    catalog, facts = v.page_catalog, v.facts
    addresses = v.stored(stages.host_addresses(catalog, facts, v.resolutions))
    return stages.cidr_stage(catalog, facts, addresses, v.networks, "include").select(
        "proxy_hash", "success", "reason")


@query
def url_stage(spark, sf_dir):
    v = _Views(spark, sf_dir)
    exits = v.stored(attempts.exit_ips(v.run_exit_answers), bucketed=True)
    return stages.url_stage(
        v.page_catalog, v.facts, v.run_url_attempts, stages.exit_places(exits, v.geo),
    ).drop("seq", "kind")


@query
def speed_stage(spark, sf_dir):
    v = _Views(spark, sf_dir)
    found = stages.speed_stage(v.page_catalog, v.facts, v.run_speed_attempts, 50.0)
    return found.select("proxy_hash", "success", "reason", "mbps")


# Selection and export ------------------------------------------------------

@query
def select_top(spark, sf_dir):
    return select.select_top(_Views(spark, sf_dir).catalog, TOP_N, NOW)


@query
def keyset_page(spark, sf_dir):
    return select.keyset_page(_Views(spark, sf_dir).catalog, 100, "8")


@query
def keyset_first_page(spark, sf_dir):
    return select.keyset_page(_Views(spark, sf_dir).catalog, 100)


@query
def stored_page(spark, sf_dir):
    """The page after a hash out of the stored pages of a committed catalogue."""
    v = _Views(spark, sf_dir)
    store = SnapshotStore(spark, shared_folder(spark, "pages"))
    store.commit({"catalog": store.write(v.catalog, store.begin(), "catalog", spread=True)}, NOW)
    pages.store_pages(store, NOW)
    return pages.read_page(store, 100, "8")


@query
def latency_top_n(spark, sf_dir):
    return select.latency_top(_Views(spark, sf_dir).catalog, TOP_N).select("proxy_hash", "latency_ms")


@query
def export_lines(spark, sf_dir):
    top = select.select_top(_Views(spark, sf_dir).catalog, TOP_N, NOW)
    return link_rows(top).select("proxy_hash", "line")


@query
def export_all_lines(spark, sf_dir):
    return link_rows(_Views(spark, sf_dir).catalog).select("proxy_hash", "line")


@query
def export_headers(spark, sf_dir):
    top = select.select_top(_Views(spark, sf_dir).catalog, TOP_N, NOW)
    return header_rows(top, EXPORT, NOW, COUNT_PARAMS["candidates"])


@query
def export_headers_file(spark, sf_dir):
    top = select.select_top(_Views(spark, sf_dir).catalog, TOP_N, NOW)
    return header_rows(top, ExportOptions(separate_headers=True, support_url="https://s.example"), NOW)


@query
def export_banner(spark, sf_dir):
    top = select.select_top(_Views(spark, sf_dir).catalog, TOP_N, NOW)
    return banner_rows(top, EXPORT, NOW, **COUNT_PARAMS)


def _export_file(spark, sf_dir, options):
    """The lines of the written file with their numbers; it holds the top n only."""
    top = select.select_top(_Views(spark, sf_dir).catalog, TOP_N, NOW)
    path = shared_folder(spark, "export")
    write_export(top, options, NOW, path, **COUNT_PARAMS)
    whole = spark.read.text(path, wholetext=True).where("value <> ''")
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("n", "line"))


@query
def export_file(spark, sf_dir):
    return _export_file(spark, sf_dir, EXPORT)


@query
def export_file_by_speed(spark, sf_dir):
    return _export_file(spark, sf_dir, replace(EXPORT, order="mbps"))


# Streams and whole runs ----------------------------------------------------

@query
def stream_apply_results(spark, sf_dir):
    v = _Views(spark, sf_dir)
    folder = shared_folder(spark, "stream-results")
    v.results.write.parquet(f"{folder}/landed")
    landed = spark.readStream.schema(RESULTS).parquet(f"{folder}/landed")
    result_stream.start_results_stream(
        landed, f"{folder}/folded", f"{folder}/checkpoint").awaitTermination()
    return result_stream.current_catalog(spark, v.catalog, f"{folder}/folded", NOW)


def _streamed_attempts(spark, sf_dir, columns):
    """The first attempts of each test, streamed in two parts, the first of them compacted."""
    rows = _Views(spark, sf_dir).attempts.select("test_id", "attempt_seq", *columns)
    folder = shared_folder(spark, "stream-attempts")
    store = SnapshotStore(spark, f"{folder}/state")

    def land(part):
        part.write.mode("append").parquet(f"{folder}/landed")
        landed = spark.readStream.schema(rows.schema).parquet(f"{folder}/landed")
        attempt_stream.start_attempts_stream(
            landed, f"{folder}/first", f"{folder}/checkpoint", "test_id").awaitTermination()

    land(rows.where(F.col("attempt_seq") % 2 == 1))
    attempt_stream.compact(store, f"{folder}/first", rows.schema, NOW, "test_id")
    land(rows.where(F.col("attempt_seq") % 2 == 0))
    return attempt_stream.attempts_so_far(store, f"{folder}/first", rows.schema, "test_id")


@query
def stream_attempts(spark, sf_dir):
    return attempts.url_outcomes(_streamed_attempts(spark, sf_dir, ["ok", "latency_ms"]), "test_id")


@query
def stream_speed_attempts(spark, sf_dir):
    return attempts.speed_outcomes(
        _streamed_attempts(spark, sf_dir, ["ok", "n_bytes", "duration_s"]), "test_id", 50.0)


@query
def stream_changed_sources(spark, sf_dir):
    v = _Views(spark, sf_dir)
    folder = shared_folder(spark, "stream-payloads")
    payloads = v.content.withColumn("arrived", F.lit(NOW).cast("bigint"))
    payloads.write.parquet(f"{folder}/landed")
    landed = spark.readStream.schema(payloads.schema).parquet(f"{folder}/landed")
    changed.start_payload_stream(
        landed, v.source_state, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return changed.changed_links(spark, f"{folder}/out")


def _inputs(v, payloads):
    return Inputs(
        payloads=payloads, converted=v.outbounds, url_attempts=v.run_url_attempts,
        exit_answers=v.run_exit_answers, speed_attempts=v.run_speed_attempts,
        resolutions=v.resolutions, networks=v.parsed_networks, geo=v.geo_networks)


def _params(now):
    return Params(now=now, target=10, speed_threshold=2.0, cidr_method="include",
                  country_method="exclude", countries=("SB", "SC"), elapsed=12.5)


def first_run(spark, sf_dir):
    """A whole run from empty state."""
    v = _Views(spark, sf_dir)
    return run_once(spark, shared_folder(spark, "run"), _inputs(v, v.content), _params(NOW))


def second_run(spark, sf_dir):
    """A day after the first run: some sources changed their text but not their links."""
    v, root = _Views(spark, sf_dir), shared_folder(spark, "run")
    run_once(spark, root, _inputs(v, v.content), _params(NOW))["store"].close()
    changed = F.substring_index("source", "/", 1).isin(*CHANGED_SOURCES)
    content = v.payloads.select("source", F.encode(F.when(
        changed, F.concat("body", F.lit("\n"))).otherwise(F.col("body")), "UTF-8").alias("content"))
    return run_once(spark, root, _inputs(v, content), _params(NOW_2))


@query
def run_once_selected(spark, sf_dir):
    return first_run(spark, sf_dir)["selected"]


@query
def run_once_catalog(spark, sf_dir):
    return first_run(spark, sf_dir)["catalog"]


@query
def run_once_dead(spark, sf_dir):
    return first_run(spark, sf_dir)["dead"]


@query
def second_run_catalog(spark, sf_dir):
    return second_run(spark, sf_dir)["catalog"]


@query
def second_run_selected(spark, sf_dir):
    return second_run(spark, sf_dir)["selected"]


@query
def second_run_sources(spark, sf_dir):
    return second_run(spark, sf_dir)["sources"]


@query
def second_run_totals(spark, sf_dir):
    return second_run(spark, sf_dir)["totals"]


@query
def second_run_dead(spark, sf_dir):
    return second_run(spark, sf_dir)["dead"]


@query
def stored_status_counts(spark, sf_dir):
    """Endpoints per status after two runs, out of the log."""
    return second_run(spark, sf_dir)["store"].status_counts()


@query
def run_figures(spark, sf_dir):
    """What a second run, after all entries of the dead-list ended, tells of itself."""
    v, root = _Views(spark, sf_dir), shared_folder(spark, "run")
    run_once(spark, root, _inputs(v, v.content), _params(NOW))["store"].close()
    state = run_once(spark, root, _inputs(v, v.content), _params(NOW + 40 * 86400))
    told = {"candidates": state["candidates"], **state["figures"]}
    return spark.createDataFrame(sorted(told.items()), "figure string, n bigint")


@query
def stream_resume_sources(spark, sf_dir):
    """Stored state after a stream, a run that read newer payloads, and a compaction of the same stream again."""
    v = _Views(spark, sf_dir)
    folder = shared_folder(spark, "stream-payloads")
    payloads = v.content.withColumn("arrived", F.lit(NOW).cast("bigint"))
    payloads.write.parquet(f"{folder}/landed")
    store = SnapshotStore(spark, f"{folder}/state")
    store.commit({"sources": store.write(v.source_state, store.begin(), "sources", bucketed=False)}, NOW)
    landed = spark.readStream.schema(payloads.schema).parquet(f"{folder}/landed")
    changed.start_payload_stream(
        landed, v.source_state, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    changed.compact(store, f"{folder}/out", NOW)

    place = store.begin()
    seen = v.payloads.where(F.substring_index("source", "/", 1).isin(*CHANGED_SOURCES)).select(
        "source", F.sha2(F.concat("body", F.lit("\n")), 256).alias("data_hash"))
    newer = ingest.upsert_source_state(store.load()["sources"], seen)
    store.commit({"sources": store.write(newer, place, "sources", bucketed=False)}, NOW_2)
    changed.compact(store, f"{folder}/out", NOW_2)
    store.begin()
    return store.load()["sources"]
