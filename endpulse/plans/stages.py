"""The three test stages: catalogue and recorded observations in, results out.

Results have one row per endpoint, (proxy_hash, seq, kind, success, reason and
metrics). Everything is joined on ``proxy_hash``: with bucketed tables neither
the catalogue nor the link facts are shuffled.
"""

from pyspark.sql import functions as F

from ..functions.netaddr import host_key
from ..functions.outbound import BROKEN, MISSING, UNSAFE, UNUSABLE
from ..operators.attempts import (
    ATTEMPTS, attempt_bytes, latency_ms, speed_outcomes, stop_point, url_outcomes,
)
from ..operators.catalog import METRICS, status_label
from ..operators.containment import host_verdicts, resolve_hosts, with_geo
from ..operators.skew import lookup_join
from ..schemas import (
    REASON_CIDR, REASON_INVALID, REASON_OK, REASON_SPEED_FAILED, REASON_URL_FAILED, RESULTS,
)


def _endpoints(catalog, facts):
    """Endpoints to test, with what is known of their configuration."""
    known = facts.select("proxy_hash", "host", "verdict")
    return catalog.select("proxy_hash").join(known, "proxy_hash", "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit(MISSING)))


def _results(rows, kind, **columns):
    """Rows as results; columns that a stage does not measure are NULL."""
    types = {f.name: f.dataType for f in RESULTS}
    fixed = {"kind": F.lit(kind), **columns}
    return rows.select(*[
        fixed.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()])


def _with_host_key(endpoints):
    configured = F.when(~F.col("verdict").isin(*UNUSABLE), F.col("host"))
    return endpoints.withColumn("host_key", host_key(configured))


def host_addresses(catalog, facts, resolutions):
    """(host, address) of the endpoints' hosts; to be stored for ``cidr_stage``."""
    hosts = _with_host_key(_endpoints(catalog, facts)).select(F.col("host_key").alias("host"))
    return resolve_hosts(hosts.where(F.col("host").isNotNull()), resolutions)


def cidr_stage(catalog, facts, addresses, networks, method="exclude", flags=None):
    """Does each endpoint's host lie in the networks (include) or not (exclude)?

    ``addresses`` are the stored ``host_addresses``, ``flags`` their ``address_flags``, if
    these are stored too. An endpoint whose configuration names no host gets no result.
    """
    missing = F.col("verdict").isin(*UNUSABLE)
    rows = _with_host_key(_endpoints(catalog, facts)).where(missing | F.col("host").isNotNull())
    verdicts = host_verdicts(addresses, networks, method, flags).withColumnRenamed("host", "host_key")
    tested = lookup_join(rows, verdicts, "host_key", "proxy_hash")
    passed = ~missing & F.coalesce("passed", F.lit(False))
    return _results(
        tested, "cidr", proxy_hash=F.col("proxy_hash"), success=passed,
        reason=F.when(missing, REASON_INVALID).when(passed, REASON_OK).otherwise(REASON_CIDR))


def hostless(catalog, facts):
    """Endpoints that the CIDR stage rejects without a result."""
    return _endpoints(catalog, facts).where(
        ~F.col("verdict").isin(*UNUSABLE) & F.col("host").isNull()).select("proxy_hash")


def exit_places(exits, geo=None):
    """Stored exit addresses with country and city.

    ``geo`` are the networks of ``containment.geo_networks``; without them
    country and city are NULL.
    """
    if geo is None:
        nothing = F.lit(None).cast("string")
        return exits.withColumns({"country": nothing, "city": nothing})
    return with_geo(exits, geo, "proxy_hash")


def within(attempts, column, timeout):
    """Attempts that took longer than the timeout (seconds; None: any time) count as failed."""
    if timeout is None:
        return attempts
    return attempts.withColumn("ok", F.col("ok") & F.coalesce(F.col(column) <= timeout, F.lit(True)))


def timed_url_attempts(attempts, timeout=None):
    """Attempts with latency_ms; where they tell elapsed seconds (elapsed_s) it is computed from them."""
    if "latency_ms" not in attempts.columns:
        attempts = attempts.withColumn("latency_ms", F.when(F.col("ok"), latency_ms(F.col("elapsed_s"))))
    return within(attempts, "latency_ms", timeout and timeout * 1000)


def sized_speed_attempts(attempts, chunks=None, timeout=None):
    """Attempts with n_bytes; with chunk rows (proxy_hash, attempt_seq, n_bytes) it is their sum."""
    if chunks is not None:
        key = ["proxy_hash", "attempt_seq"]
        attempts = attempts.drop("n_bytes").join(attempt_bytes(chunks, key), key, "left")
    return within(attempts, "duration_s", timeout)


def url_stage(catalog, facts, attempts, exits, max_attempts=ATTEMPTS):
    """Latency, exit address and its place (``exits``, from ``exit_places``)."""
    rows = (
        _endpoints(catalog, facts)
        .join(url_outcomes(attempts, max_attempts=max_attempts), "proxy_hash", "left")
        .join(exits, "proxy_hash", "left")
    )
    refused = F.col("verdict").isin(*UNUSABLE, UNSAFE)
    passed = ~refused & (F.col("verdict") != BROKEN) & F.coalesce("success", F.lit(False))
    if_passed = lambda name: F.when(passed, F.col(name))
    return _results(
        rows, "url", proxy_hash=F.col("proxy_hash"), seq=F.col("seq"), success=passed,
        reason=F.when(refused, REASON_INVALID).when(passed, REASON_OK)
            .otherwise(REASON_URL_FAILED),
        **{c: if_passed(c) for c in ("latency_ms", "exit_ip", "country", "city")})


def speed_stage(catalog, facts, attempts, threshold=1.0, max_attempts=ATTEMPTS):
    """Speeds before the early stop; an endpoint that was not tried has no result.

    ``seq`` is NULL where the configuration was refused without an attempt.
    """
    rows = _endpoints(catalog, facts).join(
        speed_outcomes(attempts, threshold=threshold, max_attempts=max_attempts),
        "proxy_hash", "left")
    refused = F.col("verdict").isin(*UNUSABLE, UNSAFE)
    broken = F.col("verdict") == BROKEN
    untried = refused | broken
    return _results(
        rows.where(untried | F.col("success").isNotNull()), "speed",
        proxy_hash=F.col("proxy_hash"), seq=F.when(~untried, F.col("seq")),
        success=~untried & F.col("success"),
        reason=F.when(refused, REASON_INVALID).when(broken, REASON_SPEED_FAILED)
            .otherwise(F.col("reason")),
        mbps=F.when(~untried, F.col("mbps")))


def stop_speed_tests(results, target):
    """Speed results up to the target-th success.

    Endpoints are taken in order of their hash. Those refused without an
    attempt count as reached up to the greatest hash among the kept attempts.
    Read ``results`` from a written table: it is scanned three times, twice
    for a few columns only.
    """
    last = stop_point(results, target)
    kept = results.where(F.col("seq") <= last.scalar())
    reached = kept.agg(F.max("proxy_hash")).scalar()
    in_time = F.when(F.col("seq").isNotNull(), F.col("seq") <= last.scalar()).otherwise(
        F.col("proxy_hash") <= reached)
    return results.where(F.coalesce(in_time, F.lit(True)))


def outcomes(results):
    """Results with one row per endpoint in the form ``update_catalog`` takes."""
    return results.select(
        "proxy_hash", status_label(F.col("kind"), F.col("success")).alias("status"),
        "reason", *METRICS)
