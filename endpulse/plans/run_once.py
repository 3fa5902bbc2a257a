"""One whole run: ingest, merge, test stages, selection, export.

The catalogue is written once, at the end. A stage stores only its outcomes, bucketed
like the catalogue; the next one leaves out the hashes of those that died, without a
shuffle. At the end all outcomes are joined to the old catalogue. Rows that died are in
that table, from which the dead-list takes them in one upsert; readers leave them out.

A run that was killed goes on from the tables it finished when it is started again with
the same state, inputs and parameters: its folder is named by their fingerprint.
"""

import hashlib
import re
import time
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, functions as F

from ..functions.durations import duration_seconds
from ..operators import attempts, catalog as cat, containment, ingest, select
from ..operators.skew import lookup_join
from ..schemas import STATUS_DEAD, check_method
from ..sources.export import ExportOptions, write_export
from ..sources.snapshots import SnapshotStore
from . import stages


@dataclass(frozen=True)
class Inputs:
    """Observations of one run; see ``schemas`` and the stage functions."""

    payloads: DataFrame
    converted: DataFrame
    url_attempts: DataFrame
    exit_answers: DataFrame
    speed_attempts: DataFrame
    resolutions: DataFrame | None = None
    networks: DataFrame | None = None
    geo: DataFrame | None = None
    # Rows of received chunks (proxy_hash, attempt_seq, n_bytes), if speed_attempts tells no bytes.
    speed_chunks: DataFrame | None = None


@dataclass(frozen=True)
class Params:
    now: int
    target: int = 25
    ttl_days: int = 30
    max_attempts: int = 3
    speed_threshold: float = 1.0
    url_timeout: str | None = None  # durations such as 2s or 500ms; slower attempts failed
    speed_timeout: str | None = None
    latency_top: int | None = None  # test the speed of so many only, those of least latency
    cidr_method: str | None = None  # None: no CIDR stage
    country_method: str | None = None  # None: no country filter, no geo labels
    countries: tuple = ()
    # "before": a source counts as read even if its links could not be
    # converted; "after": only once the converter knows all its links.
    commit_state: str = "before"
    elapsed: float | None = None  # seconds told in the export; None: as measured
    export: ExportOptions = field(default_factory=ExportOptions)

    def __post_init__(self):
        for method in (self.cidr_method, self.country_method):
            if method is not None:
                check_method(method)
        if self.commit_state not in ("before", "after"):
            raise ValueError(f"commit_state must be 'before' or 'after', not {self.commit_state!r}")
        if self.target <= 0 or self.max_attempts <= 0 or (self.latency_top or 1) <= 0:
            raise ValueError("target, max_attempts and latency_top must be positive")
        if self.ttl_days < 0:
            raise ValueError("ttl_days must not be negative")


def _new_sources(sources, counts, facts, commit_state):
    if commit_state == "after":
        # A source without links holds one row without a hash; a link may be listed by very many.
        known = facts.select("proxy_hash", F.lit(True).alias("known"))
        rows = lookup_join(counts, known, "proxy_hash", "source").groupBy("source", "data_hash").agg(
            F.count_if(F.col("proxy_hash").isNotNull() & F.col("known").isNull()).alias("open"))
        seen = rows.where(F.col("open") == 0)
    else:
        seen = counts.select("source", "data_hash").distinct()
    return ingest.upsert_source_state(sources, seen)


def _seconds(spark, text):
    """The seconds of a duration text; None for None."""
    if text is None:
        return None
    seconds = spark.range(1).select(duration_seconds(F.lit(text))).first()[0]
    if seconds is None:
        raise ValueError(f"not a positive duration: {text!r}")
    return seconds


def fingerprint(spark, inputs, params):
    """What tells a run from another: parameters, and each input's plan and files, or its rows if it has none."""
    told = [repr([(f.name, getattr(params, f.name)) for f in fields(params) if f.name != "elapsed"])]
    for name in (f.name for f in fields(inputs)):
        table = getattr(inputs, name)
        if table is None:
            told.append(f"{name}: none")
            continue
        paths = sorted(table.inputFiles())
        if paths:
            plan = table._jdf.queryExecution().analyzed().toString()
            told.append(name + ": " + re.sub(r"#\d+L?|plan_id=\d+|@[0-9a-f]+", "", plan))
            for path in paths:
                path = spark._jvm.org.apache.hadoop.fs.Path(path)
                status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
                told.append(f"{path.toString()} {status.getLen()} {status.getModificationTime()}")
        else:
            row = F.xxhash64(*[F.col(f"`{c}`") for c in table.columns]).cast("decimal(38)")
            told.append(f"{name}: {tuple(table.agg(F.count('*'), F.sum(row)).first())}")
    return hashlib.sha256("\n".join(told).encode()).hexdigest()[:32]


def run_once(spark, root, inputs, params, export_path=None, headers_path=None):
    """Run all stages on the state under ``root`` and make the new state current.

    Returns the new state tables, the ingest totals and the run's figures. Raises
    CommitConflict where another run committed meanwhile; run again then.
    """
    if params.cidr_method and (inputs.networks is None or inputs.resolutions is None):
        raise ValueError("a cidr_method needs networks and resolutions")
    store = SnapshotStore(spark, root)
    try:
        return _run(spark, store, inputs, params, export_path, headers_path)
    except BaseException:
        store.close()  # the names of its tables go
        raise


def _run(spark, store, inputs, params, export_path, headers_path):
    start = time.monotonic()
    url_timeout, speed_timeout = (_seconds(spark, t) for t in (params.url_timeout, params.speed_timeout))
    figures = {}
    folder, written, now = store.begin(fingerprint(spark, inputs, params)), {}, params.now

    def save(name, make, **how):
        """The stored table; what an earlier attempt of this run has finished is not made again."""
        entry = store.finished(folder, name)
        if entry is None:
            store.clear(f"{folder}/{name}")
            entry = store.write(make(), folder, name, **how)
            store.finish(folder, name, entry)
        written[name] = entry
        return store.read(entry)

    alive = lambda table: table.where(~cat.is_dead())
    state = store.load()
    dead = cat.expire_dead(state["dead"], now)
    figures["expired"] = state["dead"].where(F.col("expires_at") < now).count()

    # Ingest: payloads are read once; a source without links keeps a NULL row.
    changed = save("changed", lambda: ingest.changed_sources(inputs.payloads, state["sources"]), bucketed=False)
    counted = lambda lines: ingest.link_counts(
        ingest.hashed_links(lines, "data_hash", "arrived"), "data_hash", "arrived")
    counts = save("link_counts", lambda: ingest.changed_lines(
        inputs.payloads, changed, then=counted).drop("arrived"), bucketed=False)
    facts = save("facts", lambda: ingest.outbound_facts(inputs.converted))
    links = counts.where(F.col("proxy_hash").isNotNull())
    save("sources", lambda: _new_sources(state["sources"], counts, facts, params.commit_state),
         bucketed=False)
    totals = ingest.ingest_totals(links, facts, dead)
    # Stages need the endpoints' hashes only; the catalogue is put together from outcomes.
    endpoints = save("endpoints", lambda: cat.merged_endpoints(
        state["catalog"], cat.living(ingest.fresh_candidates(links, facts), dead)))
    table = cat.merged_catalog(state["catalog"], endpoints, now)
    passed = lambda keys, outcomes: keys.select("proxy_hash").join(
        outcomes.where(F.col("status") == STATUS_DEAD).select("proxy_hash"), "proxy_hash", "left_anti")

    tested = endpoints
    if params.cidr_method:
        networks = save("networks", lambda: inputs.networks, bucketed=False)
        addresses = save("addresses", lambda: stages.host_addresses(
            endpoints, facts, inputs.resolutions), bucketed=False)
        flags = save("address_flags", lambda: containment.address_flags(addresses, networks), bucketed=False)
        outcomes = save("cidr_outcomes", lambda: stages.outcomes(
            stages.cidr_stage(endpoints, facts, addresses, networks, params.cidr_method, flags)))
        figures["hostless"] = endpoints.count() - outcomes.count()  # all others have an outcome
        table = cat.update_catalog(table, outcomes, now)
        tested = passed(endpoints, outcomes)

    geo = None
    if params.country_method and inputs.geo is not None:
        geo = save("geo", lambda: containment.geo_networks(inputs.geo), bucketed=False)
    exits = save("exits", lambda: attempts.exit_ips(inputs.exit_answers))
    places = stages.exit_places(exits) if geo is None else save(
        "exit_places", lambda: stages.exit_places(exits, geo))
    outcomes = save("url_outcomes", lambda: stages.outcomes(stages.url_stage(
        tested, facts, stages.timed_url_attempts(inputs.url_attempts, url_timeout), places, params.max_attempts)))
    candidates = outcomes.count()  # each of them has one
    # Dead rows have no outcomes, and the filter leaves them as they are.
    table = cat.update_catalog(table, outcomes, now)
    if params.country_method:
        table = cat.country_filter(table, params.countries, params.country_method)

    after_url = table
    reached = save("reached", lambda: alive(after_url).select("proxy_hash", "last_status", "latency_ms"))
    figures["speed_candidates"] = reached.count()
    if params.latency_top:
        reached = reached.join(
            select.latency_top(reached, params.latency_top).select("proxy_hash"), "proxy_hash", "left_semi")
    results = save("speed_results", lambda: stages.speed_stage(
        reached, facts,
        stages.sized_speed_attempts(inputs.speed_attempts, inputs.speed_chunks, speed_timeout),
        params.speed_threshold, params.max_attempts))
    kept = stages.stop_speed_tests(results, params.target)
    table = save("catalog", lambda: cat.update_catalog(after_url, stages.outcomes(kept), now), counted="last_status")

    # Without burials the stored dead-list stays as it is; readers leave out what is past its time.
    counts = written["catalog"].get("counts")
    if counts is None or any(status == STATUS_DEAD for status, _ in counts["rows"]):
        save("dead", lambda: cat.bury(dead, table.where(cat.is_dead()).select(
            "proxy_hash", "raw_link", "scheme", "reason"), now, params.ttl_days))
    selected = select.select_top(table, params.target, now)
    if selected is not None:
        save("selected", lambda: selected, bucketed=False)

    run = store.commit({n: e for n, e in written.items()
                        if n in ("catalog", "dead", "selected", "sources")}, now)
    state = store.load()
    result = {**state, "dead": cat.expire_dead(state["dead"], now), "totals": totals, "run": run, "candidates": candidates,
              "facts": facts, "store": store, "figures": figures}
    figures["selected"] = result["selected"].count()
    if export_path:
        elapsed = time.monotonic() - start if params.elapsed is None else params.elapsed
        write_export(result["selected"], params.export, now, export_path, elapsed, candidates,
                     headers_path)
    return result
