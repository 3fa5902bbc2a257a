from pyspark.sql import functions as F

from endpulse import schemas
from endpulse.operators import attempts
from endpulse.plans import stages


def keyed(df, key="proxy_hash"):
    return {r[key]: r for r in df.collect()}


def test_first_good_attempt_of_three(spark):
    rows = spark.createDataFrame([
        ("a", 1, False, None), ("a", 2, True, 20.0), ("a", 3, True, 10.0),
        ("b", 1, False, None), ("b", 2, False, None), ("b", 3, False, None), ("b", 4, True, 1.0),
        ("c", 9, True, 5.0)], "proxy_hash string, attempt_seq long, ok boolean, latency_ms double")
    got = keyed(attempts.url_outcomes(rows))
    assert tuple(got["a"])[1:] == (2, True, "ok", 20.0)
    assert tuple(got["b"])[1:] == (3, False, "url_test_failed", None)
    assert tuple(got["c"])[1:] == (9, True, "ok", 5.0)


def test_speeds(spark):
    mib = 131072  # bytes per second that make one mebibit
    rows = spark.createDataFrame([
        ("at", 1, True, mib, 1.0), ("over", 1, True, 0, 0.0), ("over", 2, True, 4 * mib, 2.0),
        ("zero", 1, True, mib, 0.0), ("none", 1, False, None, 1.0), ("empty", 1, True, 0, 1.0)],
        "proxy_hash string, attempt_seq long, ok boolean, n_bytes long, duration_s double")
    got = keyed(attempts.speed_outcomes(rows, threshold=1.0))
    assert tuple(got["at"])[1:] == (1, False, "speed_below_threshold", 1.0)
    assert tuple(got["over"])[1:] == (2, True, "ok", 2.0)
    assert tuple(got["zero"])[1:] == (1, False, "speed_test_failed", None)
    assert tuple(got["none"])[1:] == (1, False, "speed_test_failed", None)
    assert tuple(got["empty"])[1:] == (1, False, "speed_below_threshold", 0.0)


def test_exit_ip_takes_the_first_answer(spark):
    rows = spark.createDataFrame([
        ("a", 1, False, "x"), ("a", 2, True, " 1.2.3.4\n"), ("b", 1, True, "  "), ("b", 2, True, "5.6.7.8"),
        ("c", 5, True, "9.9.9.9"), *[("c", i, False, None) for i in range(1, 5)]],
        "proxy_hash string, answer_seq long, ok boolean, body string")
    assert {k: r.exit_ip for k, r in keyed(attempts.exit_ips(rows)).items()} == {"a": "1.2.3.4", "b": None, "c": None}


def test_attempt_limit_works_before_the_shuffle(spark):
    rows = spark.range(100000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).cast("string").alias("proxy_hash"),
        F.col("id").alias("attempt_seq"), (F.col("id") > 50000).alias("ok"), F.col("id").cast("double").alias("latency_ms"))
    out = attempts.url_outcomes(rows)
    assert out.where("proxy_hash = '0'").collect()[0].success is False
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def speeds(spark, *rows):
    full = [(seq, h, "speed", ok, "ok", None, None, None, None, 1.0) for h, seq, ok in rows]
    return spark.createDataFrame(full, schemas.RESULTS)


def test_early_stop(spark):
    rows = speeds(spark, ("a", 1, True), ("b", 2, False), ("c", 3, True), ("d", 4, True))
    kept = lambda n: sorted(r.proxy_hash for r in attempts.early_stop(rows, n).collect())
    assert kept(2) == ["a", "b", "c"] and kept(3) == kept(4) == ["a", "b", "c", "d"]


def test_refused_endpoints_count_as_reached_in_hash_order(spark):
    rows = speeds(spark, ("b", 1, True), ("d", 2, True), ("f", 3, True), ("a", None, False), ("c", None, False),
                  ("e", None, False))
    kept = lambda n: sorted(r.proxy_hash for r in stages.stop_speed_tests(rows, n).collect())
    assert kept(2) == ["a", "b", "c", "d"]
    assert kept(4) == ["a", "b", "c", "d", "e", "f"]
