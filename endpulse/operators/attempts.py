"""Outcomes of repeated test attempts.

Only the first few attempts of a test count. Spark limits a
``row_number() <= n`` filter on the map side already, so a test with very many
attempts sends at most n rows per task to its group.
"""

from pyspark.sql import Window, functions as F

from ..functions.text import strip
from ..schemas import (
    REASON_OK, REASON_SPEED_FAILED, REASON_TOO_SLOW, REASON_URL_FAILED,
)

ATTEMPTS = 3
EXIT_SOURCES = 4
# Most successes that one task sorts to find where tests stop, and ranges of one round of counting.
TASK_ROWS = 10_000
RANGES = 1024


def first_rows(rows, key, order, n):
    """The first n rows of each key."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("rank_in_key", rank).where(F.col("rank_in_key") <= n).drop("rank_in_key")


def latency_ms(elapsed_s):
    return elapsed_s * 1000


def url_outcomes(attempts, key="proxy_hash", max_attempts=ATTEMPTS):
    """Per test: latency of the first good attempt and the reason.

    ``attempts`` has (key, attempt_seq, ok, latency_ms).
    """
    good = F.col("ok") & F.col("latency_ms").isNotNull()
    hit = F.struct("attempt_seq", "latency_ms")
    return (
        first_rows(attempts.select(key, "attempt_seq", "ok", "latency_ms"),
                   key, "attempt_seq", max_attempts)
        .groupBy(key)
        .agg(F.min(F.when(good, hit)).alias("hit"), F.max("attempt_seq").alias("last_seq"))
        .select(
            key,
            F.coalesce("hit.attempt_seq", "last_seq").alias("seq"),
            F.col("hit").isNotNull().alias("success"),
            F.when(F.col("hit").isNotNull(), REASON_OK).otherwise(REASON_URL_FAILED).alias("reason"),
            F.col("hit.latency_ms").alias("latency_ms"),
        )
    )


def mebibits_per_second(n_bytes, duration_s):
    return n_bytes / duration_s * 8 / 1048576


def speed_outcomes(attempts, key="proxy_hash", threshold=1.0, max_attempts=ATTEMPTS):
    """Per test: speed of the first good attempt, success and reason.

    ``attempts`` has (key, attempt_seq, ok, n_bytes, duration_s). A speed at
    the threshold is too slow, but recorded.
    """
    good = F.col("ok") & (F.col("duration_s") > 0) & F.col("n_bytes").isNotNull()
    mbps = F.when(good, mebibits_per_second(
        F.col("n_bytes"), F.nullif("duration_s", F.lit(0.0))))
    hit = F.struct("attempt_seq", mbps.alias("mbps"))
    fast = F.col("hit.mbps") > threshold
    return (
        first_rows(attempts.select(key, "attempt_seq", "ok", "n_bytes", "duration_s"),
                   key, "attempt_seq", max_attempts)
        .groupBy(key)
        .agg(F.min(F.when(good, hit)).alias("hit"), F.max("attempt_seq").alias("last_seq"))
        .select(
            key,
            F.coalesce("hit.attempt_seq", "last_seq").alias("seq"),
            F.coalesce(fast, F.lit(False)).alias("success"),
            F.when(F.col("hit").isNull(), REASON_SPEED_FAILED).when(fast, REASON_OK)
                .otherwise(REASON_TOO_SLOW).alias("reason"),
            F.col("hit.mbps").alias("mbps"),
        )
    )


def attempt_bytes(chunks, key):
    """Bytes received, from rows of chunks."""
    return chunks.groupBy(key).agg(F.sum("n_bytes").alias("n_bytes"))


def exit_ips(answers, key="proxy_hash", max_sources=EXIT_SOURCES):
    """Per test: the first answer that came; a blank one counts and gives NULL."""
    body = F.nullif(strip(F.col("body")), F.lit(""))
    answer = F.struct("answer_seq", body.alias("exit_ip"))
    return (
        first_rows(answers.select(key, "answer_seq", "ok", "body"), key, "answer_seq", max_sources)
        .groupBy(key)
        .agg(F.min(F.when(F.col("ok"), answer)).alias("answer"))
        .select(key, F.col("answer.exit_ip").alias("exit_ip"))
    )


def stop_point(results, target, task_rows=TASK_ROWS):
    """The seq of the target-th success in order of arrival (one row).

    NULL when there are fewer successes, so nothing is cut off. A target beyond
    ``task_rows`` is narrowed down first: successes are counted per range of seq, and the
    range with the target-th one is divided again until it holds ``task_rows``
    successes at most. So no task sorts more, whatever the target. Each round scans the
    results once and returns RANGES + 1 counts at most; there are seven rounds at most.
    """
    hits = results.where(F.col("success") & F.col("seq").isNotNull()).select("seq")
    if target > task_rows:
        hits, target = _narrowed(hits, target, task_rows)
    first = hits.orderBy("seq").limit(target)
    return first.agg(F.when(F.count("*") >= target, F.max("seq")).alias("last_seq"))


def _narrowed(hits, target, task_rows):
    """(hits of the range that holds the target-th one, its number in that range)."""
    ends = hits.agg(F.min("seq"), F.max("seq"), F.count("*")).first()
    if ends[2] < target:
        return hits.limit(0), 1
    bits, held, inside = (ends[1] - ends[0]).bit_length(), ends[2], hits
    while held > task_rows and bits:
        bits = max(0, bits - RANGES.bit_length() + 1)
        ranges = inside.groupBy(F.shiftright("seq", bits).alias("range")).agg(F.count("*").alias("n"))
        for number, held in sorted(ranges.collect()):
            if held >= target:
                break
            target -= held
        inside = hits.where(F.col("seq").between(number << bits, (number + 1 << bits) - 1))
    return inside, target


def early_stop(results, target, task_rows=TASK_ROWS):
    """Results up to the target-th success; all when there are fewer."""
    last = stop_point(results, target, task_rows).scalar()
    return results.where(F.coalesce(F.col("seq") <= last, F.lit(True)))
