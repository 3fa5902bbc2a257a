"""Transitions of the catalogue and of the dead-list.

Every function maps DataFrames to a new DataFrame; nothing is changed in
place. All joins are on ``proxy_hash``, which is unique on both sides.
"""

from pyspark.sql import functions as F

from ..schemas import (
    CATALOG_COLUMNS, check_method, REASON_COUNTRY, REASON_UNKNOWN, STATUS_DEAD, STATUS_UNKNOWN,
)

DAY = 86400
METRICS = ("latency_ms", "mbps", "exit_ip", "country", "city")


def expire_dead(dead, now):
    """The dead-list without entries past their time (one ending now stays)."""
    return dead.where(F.col("expires_at") >= now)


def living(fresh, dead):
    """Fresh candidates that are not on the dead-list."""
    return fresh.join(dead.select("proxy_hash"), "proxy_hash", "left_anti")


def merge_candidates(catalog, fresh, dead, now):
    """Catalogue after an upsert of the fresh candidates that are not dead."""
    new = living(fresh, dead).select(
        "proxy_hash", F.col("raw_link").alias("new_link"), F.col("scheme").alias("new_scheme"))
    return _merged(catalog.join(new, "proxy_hash", "full_outer"), now)


def merged_endpoints(catalog, fresh):
    """All endpoints after an upsert, with new_link and new_scheme where they are seen again or new."""
    return catalog.select("proxy_hash").join(
        fresh.select("proxy_hash", F.col("raw_link").alias("new_link"), F.col("scheme").alias("new_scheme")),
        "proxy_hash", "full_outer")


def merged_catalog(catalog, endpoints, now):
    """The catalogue's rows of ``merged_endpoints``."""
    return _merged(endpoints.join(catalog, "proxy_hash", "left"), now)


def _merged(rows, now):
    seen = F.col("new_link").isNotNull()
    when_seen = F.lit(now).cast("bigint")
    changed = {
        "raw_link": F.coalesce("new_link", "raw_link"),
        "scheme": F.coalesce("new_scheme", "scheme"),
        "first_seen_at": F.coalesce("first_seen_at", when_seen),
        "last_seen_at": F.when(seen, when_seen).otherwise(F.col("last_seen_at")),
        "last_status": F.coalesce("last_status", F.lit(STATUS_UNKNOWN)),
        "reason": F.coalesce("reason", F.lit(REASON_UNKNOWN)),
    }
    return rows.select(
        *[changed.get(name, F.col(name)).alias(name) for name in CATALOG_COLUMNS])


def status_label(kind, success):
    return F.when(success, F.concat(kind, F.lit("_ok"))).otherwise(F.lit(STATUS_DEAD))


def fold_results(results):
    """Results per endpoint: last status and reason, last known metrics.

    Each value travels with the seq of its result, so partial folds combine in
    any order (map-side, or across micro-batches through ``refold``).
    """
    status = status_label(F.col("kind"), F.col("success"))
    stamped = lambda c: F.struct(F.col("seq").alias("seq"), c.alias("v"))
    last = [F.max(stamped(F.struct(status.alias("status"), "reason"))).alias("outcome")]
    last += [F.max(F.when(F.col(m).isNotNull(), stamped(F.col(m)))).alias(m) for m in METRICS]
    return results.groupBy("proxy_hash").agg(*last)


def refold(folded):
    """One fold out of several partial ones."""
    return folded.groupBy("proxy_hash").agg(
        *[F.max(m).alias(m) for m in ("outcome", *METRICS)])


def flat_fold(folded):
    """Folded results as plain columns (status, reason and the metrics)."""
    return folded.select(
        "proxy_hash", F.col("outcome.v.status").alias("status"),
        F.col("outcome.v.reason").alias("reason"),
        *[F.col(f"{m}.v").alias(m) for m in METRICS])


def update_catalog(catalog, outcomes, now):
    """Catalogue after flat outcomes, one per endpoint; unknown ones are ignored."""
    new = outcomes.select(
        "proxy_hash", *[F.col(c).alias(f"new_{c}") for c in ("status", "reason", *METRICS)])
    tested = F.col("new_status").isNotNull()
    changed = {
        "last_status": F.coalesce("new_status", "last_status"),
        "reason": F.when(tested, F.col("new_reason")).otherwise(F.col("reason")),
        "last_checked_at": F.when(tested, F.lit(now).cast("bigint"))
            .otherwise(F.col("last_checked_at")),
        **{m: F.coalesce(f"new_{m}", m) for m in METRICS},
    }
    return catalog.join(new, "proxy_hash", "left").select(
        *[changed.get(name, F.col(name)).alias(name) for name in CATALOG_COLUMNS])


def apply_results(catalog, results, now):
    return update_catalog(catalog, flat_fold(fold_results(results)), now)


def country_filter(catalog, countries, method="exclude"):
    """Mark tested endpoints of unwanted or unknown country dead."""
    check_method(method)
    wanted = sorted({str(c).strip().upper() for c in countries or ()} - {""})
    # Over an empty list, IN is false.
    listed = F.col("country").isin(wanted) if wanted else F.lit(False)
    unwanted = F.col("country").isNull() | (listed if method == "exclude" else ~listed)
    hit = F.col("last_status").isin("url_ok", "speed_ok") & unwanted
    return catalog.withColumns({
        "last_status": F.when(hit, STATUS_DEAD).otherwise(F.col("last_status")),
        "reason": F.when(hit, REASON_COUNTRY).otherwise(F.col("reason")),
    })


def bury(dead, dying, now, ttl_days):
    """Dead-list after an upsert of dying endpoints (proxy_hash, raw_link, scheme, reason).

    An entry already there keeps all but its reason and expiry.
    """
    if ttl_days < 0:
        raise ValueError("ttl_days must not be negative")
    end = F.lit(now + ttl_days * DAY).cast("bigint")
    new = dying.select("proxy_hash", *[
        F.col(c).alias(f"new_{c}") for c in ("raw_link", "scheme")],
        F.coalesce("reason", F.lit(STATUS_DEAD)).alias("new_reason"),
        end.alias("new_expires_at"))
    return dead.join(new, "proxy_hash", "full_outer").select(
        "proxy_hash",
        F.coalesce("raw_link", "new_raw_link").alias("raw_link"),
        F.coalesce("scheme", "new_scheme").alias("scheme"),
        F.coalesce("new_reason", "reason").alias("reason"),
        F.coalesce("created_at", F.lit(now).cast("bigint")).alias("created_at"),
        F.coalesce("new_expires_at", "expires_at").alias("expires_at"),
    )


def is_dead():
    return F.col("last_status") == STATUS_DEAD


def move_dead(catalog, dead, now, ttl_days=30):
    """(catalogue without dead rows, dead-list with them)."""
    return catalog.where(~is_dead()), bury(dead, catalog.where(is_dead()), now, ttl_days)


def status_counts(catalog):
    return catalog.groupBy("last_status").agg(F.count("*").alias("n"))
