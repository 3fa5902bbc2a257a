"""From source payloads to fresh candidates.

Links are reduced to their hash before anything is shuffled by it, so a link
listed by very many sources costs one row per map task, and a source holding
much of the data is spread like any other.
"""

from pyspark.sql import functions as F

from ..functions.outbound import with_facts, with_scheme
from ..functions.text import (
    decode_utf8, is_link_line, link_hash, normalize_link, split_lines, strip, with_base64_text,
)
from .skew import lookup_join


def payload_hash(payloads):
    """Add ``data_hash``, the SHA-256 of the raw bytes."""
    return payloads.withColumn("data_hash", F.sha2("content", 256))


def changed_sources(payloads, state):
    """(source, data_hash, arrived) of the sources whose newest payload is not the stored one.

    Only hashes travel: a payload is hashed in the scan, and of a source's
    payloads the last to arrive counts (of equal ones the greatest hash).
    """
    hashed = payload_hash(_with_arrival(payloads)).select("source", "arrived", "data_hash")
    newest = hashed.groupBy("source").agg(F.max(F.struct("arrived", "data_hash")).alias("last"))
    known = state.select(F.col("link").alias("source"), "last_data_hash")
    return (
        newest.select("source", "last.data_hash", "last.arrived").join(known, "source", "left")
        .where(~F.col("data_hash").eqNullSafe(F.col("last_data_hash")))
        .drop("last_data_hash")
    )


def upsert_source_state(state, seen):
    """Source state after the payloads ``seen`` (source, data_hash) came in, one row per source."""
    order = [c for c in ("arrived", "data_hash") if c in seen.columns]
    new = seen.groupBy(F.col("source").alias("link")).agg(F.max(F.struct(*order)).alias("last"))
    return state.join(new, "link", "full_outer").select(
        "link", F.coalesce("last.data_hash", "last_data_hash").alias("last_data_hash"))


def _with_arrival(payloads):
    if "arrived" in payloads.columns:
        return payloads
    return payloads.withColumn("arrived", F.lit(0).cast("bigint"))


# So many changed sources are broadcast: their names, hashes and times.
FEW_SOURCES = 100_000


def changed_lines(payloads, changed, *carry, then=lambda lines: lines):
    """``payload_lines`` of the changed sources, put through ``then``; pass a stored ``changed``.

    Payloads are never shuffled. A short list of changed sources goes to all
    tasks, and other payloads are only hashed. With a long one, all payloads are
    split where they lie, and what ``then`` makes of their lines is shuffled; it
    has to keep source, data_hash and arrived.
    """
    key = ("source", "data_hash", "arrived")
    named = changed.select(*[F.col(c).alias(f"changed_{c}") for c in key])
    on = [F.col(c).eqNullSafe(F.col(f"changed_{c}")) for c in key]
    hashed = payload_hash(_with_arrival(payloads))
    carry = list(dict.fromkeys((*carry, "data_hash", "arrived")))
    if changed.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES:
        return then(payload_lines(hashed.join(F.broadcast(named), on, "left_semi"), *carry))
    return then(payload_lines(hashed, *carry)).join(named, on, "left_semi")


def payload_lines(payloads, *carry):
    """One row per link line of each payload, and one with a NULL line if it has none.

    Text without any link line is taken as base64 and decoded. A link mark
    holds no line end, so looking for it in the whole text is enough.
    """
    plain = F.col("plain_text")
    texts = payloads.select("source", *carry, decode_utf8(F.col("content")).alias("plain_text"))
    texts = texts.withColumn("to_decode", F.when(~is_link_line(plain), plain))
    texts = with_base64_text(texts, "to_decode", "decoded_text")
    body = F.when(F.col("to_decode").isNull(), plain).otherwise(F.col("decoded_text"))
    return (
        texts.select("source", *carry, F.filter(split_lines(body), is_link_line).alias("lines"))
        .select("source", *carry, F.explode_outer("lines").alias("line"))
        .withColumn("line", strip(F.col("line")))
    )


def payload_links(payloads, *carry):
    """One row per link line of each payload."""
    return payload_lines(payloads, *carry).where(F.col("line").isNotNull())


def link_lines(lines):
    """Lines with a link in them, without surrounding blanks."""
    return lines.where(is_link_line(F.col("line"))).withColumn("line", strip(F.col("line")))


def clean_links(lines):
    """(source, link, proxy_hash) of each link line that is not all comment."""
    return (
        lines.select("source", normalize_link(F.col("line")).alias("link"))
        .where(F.col("link") != "")
        .withColumn("proxy_hash", link_hash(F.col("link")))
    )


def hashed_links(lines, *carry):
    """(source, proxy_hash) of each line; NULL where the line holds no link."""
    link = F.nullif(normalize_link(F.col("line")), F.lit(""))
    return lines.select("source", *carry, link_hash(link).alias("proxy_hash"))


def distinct_links(links):
    """Each link hash once. Grouping by the hash alone stays a hash aggregate."""
    return links.select("proxy_hash").distinct()


def outbound_facts(converted):
    """What the stages need of the converter's output, keyed by link hash.

    Parsed once here and read by every stage: (proxy_hash, raw_link, scheme,
    host, verdict).
    """
    return with_facts(_one_per_link(converted)).drop("outbound")


def _one_per_link(converted):
    """(proxy_hash, raw_link, outbound), one row per hash: of several configurations the greatest counts."""
    keyed = converted.select(
        link_hash(F.col("link")).alias("proxy_hash"), F.col("link").alias("raw_link"), "outbound")
    return keyed.groupBy("proxy_hash").agg(F.max(F.struct("outbound", "raw_link")).alias("last")).select(
        "proxy_hash", "last.raw_link", "last.outbound")


def known_links(converted):
    """(proxy_hash, raw_link, scheme) of the links the converter accepted, one row per hash."""
    keyed = _one_per_link(converted.where(F.col("outbound").isNotNull()))
    return with_scheme(keyed).drop("outbound").where(F.col("scheme").isNotNull())


def fresh_candidates(links, known):
    """Distinct candidates among the links; links the converter rejected drop out.

    One shuffle by hash: the link text and scheme come from ``known``, which
    has one row per hash.
    """
    return distinct_links(links).join(
        known.where(F.col("scheme").isNotNull()).select("proxy_hash", "raw_link", "scheme"),
        "proxy_hash")


def stage_fresh(rows):
    """Candidates from any rows: the first per hash, rows with a NULL dropped."""
    return rows.select("proxy_hash", "raw_link", "scheme").na.drop().dropDuplicates(["proxy_hash"])


def link_counts(links, *carry):
    """How often each source lists each link."""
    return links.groupBy("source", *carry, "proxy_hash").agg(F.count("*").alias("n"))


def ingest_stats(counts, known):
    """Per source: links, links parsed, and distinct links parsed."""
    return (
        lookup_join(counts, _accepted(known), "proxy_hash", "source")
        .groupBy("source")
        .agg(
            F.sum("n").alias("total_links"),
            F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("parsed"),
            F.count("ok").alias("unique_parsed"),
        )
    )


def _accepted(known):
    return known.where(F.col("scheme").isNotNull()).select("proxy_hash", F.lit(True).alias("ok"))


def ingest_totals(counts, known, dead):
    """One row: links, parsed, unique fresh, added, and skipped as dead."""
    per_link = counts.groupBy("proxy_hash").agg(F.sum("n").alias("n"))
    gone = dead.select("proxy_hash", F.lit(True).alias("is_dead"))
    fresh = F.col("ok").isNotNull()
    return (
        per_link.join(_accepted(known), "proxy_hash", "left").join(gone, "proxy_hash", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_links"),
            F.coalesce(F.sum(F.when(fresh, F.col("n"))), F.lit(0)).alias("parsed"),
            F.count("ok").alias("unique_fresh"),
            F.count_if(fresh & F.col("is_dead").isNull()).alias("added"),
            F.count_if(fresh & F.col("is_dead").isNotNull()).alias("skipped_dead"),
        )
    )
