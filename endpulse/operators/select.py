"""Selections from the catalogue. Ties are broken by hash."""

from pyspark.sql import functions as F

SELECTED_STATUS = "speed_ok"


def select_top(catalog, n, now):
    """The n fastest endpoints of this run, or None (keep the old ones) if n <= 0."""
    if n <= 0:
        return None
    return (
        catalog.where(F.col("last_status") == SELECTED_STATUS)
        .orderBy(F.desc_nulls_last("mbps"), "proxy_hash").limit(n)
        .select("proxy_hash", F.lit(now).cast("bigint").alias("selected_at"), "raw_link",
                "latency_ms", "mbps", "exit_ip", "country", "city")
    )


def keyset_page(catalog, limit, after=None):
    """The next page of candidates in order of their hash."""
    rows = catalog if after is None else catalog.where(F.col("proxy_hash") > after)
    return rows.orderBy("proxy_hash").limit(limit).select("proxy_hash", "raw_link", "scheme")


def latency_top(catalog, n):
    """The n endpoints that answered fastest, an optional cut before speed tests."""
    return (
        catalog.where((F.col("last_status") == "url_ok") & F.col("latency_ms").isNotNull())
        .orderBy("latency_ms", "proxy_hash").limit(n)
    )
