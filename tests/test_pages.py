import random

import pytest
from pyspark.sql import functions as F

from endpulse.operators import attempts
from endpulse.schemas import CATALOG
from endpulse.sources import pages
from endpulse.sources.snapshots import SnapshotStore


def catalog(spark, hashes):
    rows = spark.createDataFrame([(h, f"vless://{h}", "url_ok") for h in hashes], "proxy_hash string, raw_link string, last_status string")
    return rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in CATALOG])


def committed(spark, root, hashes, now=1):
    store = SnapshotStore(spark, root)
    store.commit({"catalog": store.write(catalog(spark, hashes), store.begin(), "catalog", spread=True)}, now)
    return store


def test_pages_are_whole_and_read_few_files(spark, tmp_path):
    rand = random.Random(5)
    hashes = sorted({f"{rand.getrandbits(64):016x}" for _ in range(500)})
    store = committed(spark, str(tmp_path / "state"), hashes)
    pages.store_pages(store, 2, files=8)
    files = store.base()[1]["pages"]["files"]
    assert len(files) > 4 and sum(n for *_, n in files) == 500
    seen, after = [], None
    while True:
        page = pages.read_page(store, 37, after)
        assert len(page.inputFiles()) <= 3
        got = [r.proxy_hash for r in page.collect()]
        if not got:
            break
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert after is None or "GreaterThan(proxy_hash" in plan
        seen, after = seen + got, got[-1]
    assert seen == hashes
    edge = files[2][2]  # the last hash of a file
    assert [r.proxy_hash for r in pages.read_page(store, 3, edge).collect()] == hashes[hashes.index(edge) + 1:][:3]
    store.close()


def test_old_pages_of_another_catalogue_are_not_read(spark, tmp_path):
    root = str(tmp_path / "state")
    store = committed(spark, root, ["a", "c"])
    pages.store_pages(store, 2)
    newer = committed(spark, root, ["a", "b", "c"], 3)
    assert [r.proxy_hash for r in pages.read_page(newer, 2).collect()] == ["a", "b"]
    pages.store_pages(newer, 4)
    assert [r.proxy_hash for r in pages.read_page(newer, 2, "a").collect()] == ["b", "c"]
    store.close(), newer.close()


def test_pages_of_no_catalogue_and_an_empty_one(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "state"))
    assert pages.read_page(store, 5).collect() == []
    pages.store_pages(store, 1)
    assert pages.read_page(store, 5).collect() == []
    store.close()


@pytest.mark.parametrize("seed", range(2))
def test_the_stop_by_ranges_is_the_stop_by_order(spark, seed):
    rand = random.Random(seed)
    spread = [rand.randrange(-2**62, 2**62) for _ in range(200)] + rand.sample(range(10**6, 10**6 + 900), 400)
    rows = [(s, rand.random() < 0.7) for s in set(spread)] + [(None, True), (2**63 - 1, True), (-2**63, True)]
    frame = spark.createDataFrame(rows, "seq long, success boolean").cache()
    hits = sorted(s for s, ok in rows if ok and s is not None)
    for target in (1, 8, 50, len(hits) // 2, len(hits) - 1, len(hits)):
        assert attempts.stop_point(frame, target, 7).first()[0] == hits[target - 1]
    assert attempts.stop_point(frame, len(hits) + 1, 7).first()[0] is None
    frame.unpersist()
