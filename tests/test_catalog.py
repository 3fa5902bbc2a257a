import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from endpulse import schemas
from endpulse.operators import catalog as cat, select

NOW = 1700000000


def catalog(spark, *rows):
    base = dict(raw_link="ss://x", scheme="ss", first_seen_at=1, last_seen_at=2, last_checked_at=None,
                last_status="unknown", reason="unknown", latency_ms=None, mbps=None, exit_ip=None,
                country=None, city=None)
    return spark.createDataFrame(
        [tuple({**base, **row}[c] for c in schemas.CATALOG_COLUMNS) for row in rows], schemas.CATALOG)


def by_hash(df):
    return {r.proxy_hash: r for r in df.collect()}


def test_expiry_is_strict(spark):
    dead = spark.createDataFrame(
        [(h, "l", "s", "r", 0, NOW + d) for h, d in (("a", -1), ("b", 0), ("c", 1))], schemas.DEAD)
    assert set(by_hash(cat.expire_dead(dead, NOW))) == {"b", "c"}


def test_merge(spark):
    old = catalog(spark, dict(proxy_hash="old", mbps=5.0, last_status="dead"), dict(proxy_hash="gone"))
    fresh = spark.createDataFrame(
        [("old", "new-link", "vless"), ("new", "n", "ss"), ("buried", "b", "ss")], schemas.FRESH)
    dead = spark.createDataFrame([("buried", "b", "ss", "r", 0, NOW)], schemas.DEAD)
    got = by_hash(cat.merge_candidates(old, fresh, dead, NOW))
    assert set(got) == {"old", "gone", "new"}
    assert (got["old"].raw_link, got["old"].scheme, got["old"].first_seen_at, got["old"].last_seen_at,
            got["old"].mbps, got["old"].last_status) == ("new-link", "vless", 1, NOW, 5.0, "dead")
    assert (got["gone"].raw_link, got["gone"].last_seen_at) == ("ss://x", 2)
    assert (got["new"].first_seen_at, got["new"].last_status, got["new"].reason) == (NOW, "unknown", "unknown")


RESULT = schemas.RESULTS.fieldNames()


def test_fold_equals_sequential_updates(spark):
    rng = random.Random(4)
    maybe = lambda v: v if rng.random() < 0.5 else None
    rows = [(i, f"h{rng.choice([0] * 30 + list(range(40)))}", rng.choice(["url", "speed", "cidr"]),
             rng.random() < 0.6, rng.choice(["ok", "x"]), maybe(rng.random()), maybe(f"ip{i}"),
             maybe(f"c{i}"), maybe(f"t{i}"), maybe(rng.random())) for i in range(600)]
    known = [f"h{i}" for i in range(0, 40, 2)]
    db = sqlite3.connect(":memory:")
    db.execute("CREATE TABLE p (h TEXT PRIMARY KEY, s TEXT, r TEXT, lat REAL, ip TEXT, co TEXT, ci TEXT, m REAL)")
    db.executemany("INSERT INTO p VALUES (?, 'unknown', 'unknown', NULL, 'old', NULL, NULL, 1.5)", [(h,) for h in known])
    for _, h, kind, ok, reason, lat, ip, co, ci, m in rows:
        db.execute("UPDATE p SET s=?, r=?, lat=COALESCE(?,lat), ip=COALESCE(?,ip), co=COALESCE(?,co), "
                   "ci=COALESCE(?,ci), m=COALESCE(?,m) WHERE h=?",
                   (kind + "_ok" if ok else "dead", reason, lat, ip, co, ci, m, h))
    want = sorted(db.execute("SELECT * FROM p").fetchall())
    base = catalog(spark, *[dict(proxy_hash=h, exit_ip="old", mbps=1.5) for h in known])
    shuffled = rng.sample(rows, len(rows))
    results = spark.createDataFrame(shuffled, schemas.RESULTS).repartition(7)
    columns = ("proxy_hash", "last_status", "reason", "latency_ms", "exit_ip", "country", "city", "mbps")
    got = cat.apply_results(base, results, NOW)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
    checked = {r.proxy_hash for r in got.where(F.col("last_checked_at") == NOW).collect()}
    assert checked == set(known) & {r[1] for r in rows}
    # Folding parts first and then the folds gives the same.
    parts = [cat.fold_results(results.where(F.col("seq") % 3 == i)) for i in range(3)]
    twice = cat.flat_fold(cat.refold(parts[2].union(parts[0]).union(parts[1])))
    assert sorted(map(str, cat.update_catalog(base, twice, NOW).collect())) == sorted(map(str, got.collect()))


@pytest.mark.parametrize("countries, method, dead", [
    (["de", " "], "exclude", {"DE", None}), (["DE"], "include", {"FR", None}),
    ([], "exclude", {None}), ([], "include", {"DE", "FR", None})])
def test_country_filter(spark, countries, method, dead):
    rows = [dict(proxy_hash=f"{s}{c}", country=c, last_status=s, reason="ok")
            for c in ("DE", "FR", None) for s in ("url_ok", "speed_ok", "cidr_ok")]
    for r in cat.country_filter(catalog(spark, *rows), countries, method).collect():
        hit = r.country in dead and not r.proxy_hash.startswith("cidr")
        assert (r.last_status == "dead", r.reason == "discarded_filtering") == (hit, hit)


def test_move_dead_keeps_what_was_there(spark):
    table = catalog(spark, dict(proxy_hash="a", last_status="dead", reason="new", raw_link="other"),
                    dict(proxy_hash="b", last_status="dead", reason="x"), dict(proxy_hash="c"))
    dead = spark.createDataFrame([("a", "link", "ss", "old", 7, 9), ("z", "link", "ss", "old", 7, 9)], schemas.DEAD)
    left, moved = cat.move_dead(table, dead, NOW, 2)
    assert set(by_hash(left)) == {"c"}
    got = by_hash(moved)
    assert tuple(got["a"]) == ("a", "link", "ss", "new", 7, NOW + 2 * 86400)
    assert tuple(got["b"]) == ("b", "ss://x", "ss", "x", NOW, NOW + 2 * 86400)
    assert tuple(got["z"]) == ("z", "link", "ss", "old", 7, 9)
    with pytest.raises(ValueError):
        cat.move_dead(table, dead, NOW, -1)


def test_select_top(spark):
    table = catalog(spark, *[dict(proxy_hash=h, last_status=s, mbps=m) for h, s, m in (
        ("b", "speed_ok", 5.0), ("a", "speed_ok", 5.0), ("c", "speed_ok", None), ("d", "url_ok", 9.0),
        ("e", "speed_ok", 7.0))])
    pick = lambda n: [r.proxy_hash for r in select.select_top(table, n, NOW).collect()]
    assert pick(2) == ["e", "a"] and pick(9) == ["e", "a", "b", "c"]
    assert select.select_top(table, 0, NOW) is None
    assert [r.proxy_hash for r in select.keyset_page(table, 2, "b").collect()] == ["c", "d"]
