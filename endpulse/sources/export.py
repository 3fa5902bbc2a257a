"""The annotated text export of the selected endpoints."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions.export_text import (
    annotated_link, base64_text, clock, comment, iso_utc, spoken_time,
)


@dataclass(frozen=True)
class ExportOptions:
    title: str = "endpulse"
    banner: str = "endpulse"  # the name in the rule above the links
    update_interval: int = 24
    web_page_url: str | None = None
    support_url: str | None = None
    separate_headers: bool = False
    order: str = "hash"  # or "mbps"


def link_rows(selected):
    """(proxy_hash, mbps, line) of each selected endpoint."""
    remark = comment(*[F.col(c) for c in ("exit_ip", "city", "country", "latency_ms", "mbps")])
    return selected.select(
        "proxy_hash", "mbps", annotated_link(F.col("raw_link"), remark).alias("line"))


def _facts(selected, now, elapsed=None, candidates=None):
    """One row with all that the header lines tell."""
    return selected.agg(F.count("*").alias("count")).select(
        "count", F.lit(now).cast("bigint").alias("now"),
        F.lit(elapsed).cast("double").alias("elapsed"),
        F.lit(candidates).cast("bigint").alias("candidates"))


def _lines(facts, texts):
    """(ord, line) of texts in order; NULL texts are left out."""
    made = F.array(*[F.struct(F.lit(i).alias("ord"), t.alias("line")) for i, t in enumerate(texts)])
    return facts.select(F.explode(made).alias("r")).select("r.*").where(F.col("line").isNotNull())


def header_rows(selected, options, now, candidates=None):
    """(ord, line) of the profile headers.

    In the export itself they read ``#name: value``; in a file of their own
    ``add_header name "value";``.
    """
    announce = F.concat(
        F.lit("Exported at "), spoken_time(F.col("now")), F.lit("\nCount: "),
        F.col("count").cast("string"), F.lit("\n"),
        F.coalesce(F.concat(F.lit("Candidates processed: "),
                            F.col("candidates").cast("string"), F.lit("\n")), F.lit("")))
    coded = lambda c: F.concat(F.lit("base64:"), base64_text(c))
    headers = [
        ("profile-title", coded(F.lit(options.title))),
        ("profile-update-interval", F.lit(str(options.update_interval))),
        ("profile-web-page-url", F.lit(options.web_page_url or None)),
        ("support-url", F.lit(options.support_url or None)),
        ("announce", coded(announce)),
    ]
    shape = 'add_header {} "' if options.separate_headers else "#{}: "
    end = '";' if options.separate_headers else ""
    texts = [F.concat(F.lit(shape.format(name)), value.cast("string"), F.lit(end))
             for name, value in headers]
    return _lines(_facts(selected, now, None, candidates), texts)


def banner_rows(selected, options, now, elapsed=None, candidates=None):
    """(ord, line) of the lines above the links; run statistics only if known."""
    rule = "-" * 50
    stats = F.col("elapsed").isNotNull()
    texts = [
        F.lit(f"#{rule}{options.banner}{rule}"),
        F.concat(F.lit("# Exported at "), iso_utc(F.col("now"))),
        F.concat(F.lit("# Count: "), F.col("count").cast("string")),
        F.when(stats, "# Stats: "),
        F.when(stats, F.concat(F.lit("# Time elapsed: "), clock(F.col("elapsed")))),
        F.when(stats, F.concat(F.lit("# Candidates processed: "),
                               F.col("candidates").cast("string"))),
    ]
    return _lines(_facts(selected, now, elapsed, candidates), texts)


def export_rows(selected, options, now, elapsed=None, candidates=None):
    """(section, ord, speed, proxy_hash, line) of the whole export file."""
    none = lambda kind: F.lit(None).cast(kind)
    head = lambda rows, section: rows.select(
        F.lit(section).alias("section"), F.col("ord"), none("double").alias("speed"),
        none("string").alias("proxy_hash"), F.col("line"))
    speed = F.col("mbps") if options.order == "mbps" else none("double")
    rows = head(banner_rows(selected, options, now, elapsed, candidates), 1).unionByName(
        link_rows(selected).select(
            F.lit(2).alias("section"), F.lit(0).alias("ord"), speed.alias("speed"),
            "proxy_hash", "line"))
    if not options.separate_headers:
        rows = rows.unionByName(head(header_rows(selected, options, now, candidates), 0))
    return rows


def write_export(selected, options, now, path, elapsed=None, candidates=None, headers_path=None):
    """Write the export as one text file (the selection is at most the top n)."""
    (
        export_rows(selected, options, now, elapsed, candidates)
        .coalesce(1)
        .sortWithinPartitions("section", "ord", F.desc_nulls_last("speed"), "proxy_hash")
        .select("line").write.mode("overwrite").text(path)
    )
    if options.separate_headers:
        (
            header_rows(selected, options, now, candidates)
            .coalesce(1).sortWithinPartitions("ord")
            .select("line").write.mode("overwrite").text(headers_path)
        )
