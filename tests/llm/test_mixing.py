import random

import pytest
from llm.helpers import rows_of, table
from pyspark.sql import functions as F

from endpulse.llm import mixing as lib

WEIGHTS = {"a": 5, "b": 3, "c": 1, "d": 7, "*": 4}


@pytest.mark.parametrize("weights", [WEIGHTS, {"a": 1}, {"a": 97, "b": 2, "*": 1}, {f"s{i}": 1 + i % 5 for i in range(40)}])
def test_period_is_within_one_block_of_every_share(spark, weights):
    rows = lib.period(spark, weights).collect()
    weights = weights if "*" in weights else weights | {"*": 1}
    total = sum(weights.values())
    assert sorted(r["at"] for r in rows) == list(range(total))
    done = dict.fromkeys(weights, 0)
    for t, r in enumerate(sorted(rows, key=lambda r: r["at"])):
        assert r["release"] <= t < r["deadline"] and r["j"] == done[r["share"]]
        done[r["share"]] += 1
        for name, parts in weights.items():
            assert abs(done[name] - parts * (t + 1) / total) < 1


def documents(spark, n=4000, extra=None):
    rand = random.Random(2)
    rows = [(i, f"t{i}", rand.choice("aaaaabcde")) for i in range(n)]
    return table(spark, rows + [(None, "x", None), (5, "again", "a"), (5, "again", "a"), (n, None, "zz")], extra)


def test_every_row_has_one_place_and_shares_hold_while_all_last(spark):
    docs = documents(spark, extra=["slot", "__n", "j"])
    done = lib.scheduled(docs, WEIGHTS, block_docs=10)
    rows = done.collect()
    assert len(rows) == docs.count()
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    blocks = {}
    for r in rows:
        assert r["release"] <= r["slot"] < r["deadline"]
        blocks.setdefault((r["share"], r["block"]), []).append(r)
    for group in blocks.values():
        assert len({r["slot"] for r in group}) == 1 and sorted(r["place"] for r in group) == list(range(len(group)))
    first = {s: min(b for n, b in blocks if n == s) for s, _ in blocks}
    last = {s: max(b for n, b in blocks if n == s) for s, _ in blocks}
    assert all(len(blocks[s, b]) == 10 for s, b in blocks if b < last[s]) and set(first.values()) == {0}
    end = min(max(r["slot"] for r in rows if r["share"] == s) for s in last)
    total = sum(WEIGHTS.values())
    for t in range(1, end + 1):
        for s, parts in WEIGHTS.items():
            assert abs(sum(1 for n, b in blocks if n == s and blocks[n, b][0]["slot"] < t) - parts * t / total) < 1


def test_groups_of_the_order_do_not_show(spark, monkeypatch):
    docs = documents(spark, 700).where("doc_id <> 5 or text = 't5'")
    one = rows_of(lib.scheduled(docs, WEIGHTS).select("doc_id", "slot", "place"))
    monkeypatch.setattr(lib, "GROUP_ROWS", 3)
    assert rows_of(lib.scheduled(docs, WEIGHTS).select("doc_id", "slot", "place")) == one


def test_mixed_keeps_rows_and_columns_and_sorts(spark, tmp_path):
    docs = documents(spark, extra=["slot", "share"])
    mixed = lib.mixed(docs, WEIGHTS, block_docs=10)
    assert mixed.columns == docs.columns and rows_of(mixed) == rows_of(docs)
    path = str(tmp_path / "mixed")
    mixed.write.parquet(path)
    back = spark.read.parquet(path).select("doc_id", "text", F.col("_metadata.file_name").alias("f"),
                                           F.col("_metadata.row_index").alias("i")).orderBy("f", "i").collect()
    want = lib.scheduled(documents(spark), WEIGHTS, block_docs=10).orderBy("slot", "place").collect()
    got = [(r["doc_id"], r["text"]) for r in back]
    assert [r["doc_id"] for r in want] == [g[0] for g in got]


def test_bad_weights_and_empty_table(spark):
    for weights in ({"a": 0}, {"a": 1.5}, {"a": lib.MAX_PARTS + 1}):
        with pytest.raises(ValueError):
            lib.period(spark, weights)
    assert lib.scheduled(documents(spark).where("false"), WEIGHTS).count() == 0


@pytest.mark.parametrize("n, weights, want", [
    (5, {"a": 3, "*": 4}, {"a": 15, **{f"s{i}": 4 for i in range(5)}}),
    (2, {"a": 3, "*": 4}, {"a": 3, "s0": 2, "s1": 2}),
    (3, {"a": 9998, "*": 2}, {"a": 9998, "*": 2}),
    (0, {"a": 3, "*": 4}, {"a": 3, "*": 4}),
])
def test_the_rest_is_split_over_the_sources_found(spark, n, weights, want):
    docs = table(spark, [(i, "x", "a") for i in range(9)] + [(i, "x", f"s{i}") for i in range(n)]
                 + [(100 + i, "y", "s2") for i in range(2 if n == 3 else 0)])
    assert lib.split_rest(docs, weights) == want


def test_null_sources_keep_the_rest_and_many_sources_stay_together(spark):
    docs = table(spark, [(1, "x", None), (2, "x", "*"), (3, "x", "b"), (4, "x", "a")])
    assert lib.split_rest(docs, {"a": 1, "*": 1}) == {"a": 2, "b": 1, "*": 1}
    many = table(spark, [(i, "x", f"s{i}") for i in range(lib.MAX_NAMED + 50)])
    assert lib.split_rest(many, {"a": 60, "*": 40}) == {"a": 60, "*": 40}


def test_pipeline_keeps_every_source_within_one_block(spark):
    import corpus_pipeline
    rand = random.Random(4)
    docs = table(spark, [(i, "x", f"src{rand.choice([*range(12)] + [11] * 8)}") for i in range(6000)])
    sources = {r["source"] for r in docs.select("source").distinct().collect()}
    used, mixed = {}, lib.mixed
    try:
        lib.mixed = lambda d, w, **how: used.update(w) or mixed(d, w, **how)
        corpus_pipeline.mix_sources(spark, docs, "")
    finally:
        lib.mixed = mixed
    assert sources <= set(used)
    blocks = {(r["share"], r["block"]): r["slot"] for r in lib.scheduled(docs, used).collect()}
    end = min(max(t for (n, _), t in blocks.items() if n == s) for s in sources)
    total = sum(used.values()) + ("*" not in used)
    for t in range(1, end + 1):
        for s in sources:
            assert abs(sum(1 for (n, _), at in blocks.items() if n == s and at < t) - used[s] * t / total) < 1


def test_every_source_found_has_its_own_share_within_one_block(spark):
    from endpulse.llm.queries import TARGET_WEIGHTS, op10_mixing

    sf_dir = "/root/testdata/sf0.01"
    rows = op10_mixing(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(rows) == docs.count() and all(r["share"] == r["source"] for r in rows)
    weights = lib.split_rest(docs, TARGET_WEIGHTS) | {"*": 1}
    total = sum(weights.values())
    blocks = {}
    for r in rows:
        blocks.setdefault(r["share"], set()).add(r["slot"])
    end = min(max(slots) for slots in blocks.values())
    for t in range(1, end + 1):
        for share, slots in blocks.items():
            assert abs(sum(s < t for s in slots) - weights[share] * t / total) < 1


def many_sources(spark, tmp_path, m=260):
    """Documents of m sources, of which one holds a third, some only one, and of a null one."""
    rand = random.Random(8)
    names = [f"s{i}" for i in range(m)]
    rows = [(i, "x", rand.choice([names[0], rand.choice(names), rand.choice(["stackoverflow", "wiki", *names])]))
            for i in range(9000)]
    rows += [(9000 + i, "x", None) for i in range(70)] + [(9100, "x", "*"), (9101, "x", "lone"), (None, "x", "s1"), (5, "x", "s1")]
    path = str(tmp_path / "documents.parquet")
    table(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("weights", [{"wiki": 5, "stackoverflow": 2, "*": 13}, {"*": 1}, {"wiki": 9998, "*": 2}])
def test_any_number_of_sources_stays_within_one_block(spark, tmp_path, weights):
    docs = many_sources(spark, tmp_path)
    assert lib.split_rest(docs, weights) == weights
    rows = lib.scheduled(docs, weights, block_docs=4, each=True).collect()
    assert len(rows) == docs.count() and len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    total, blocks = sum(weights.values()), {}
    for r in rows:
        source = r["source"] or "*"
        assert r["release"] <= r["slot"] < r["deadline"]
        blocks.setdefault(source, {}).setdefault(r["slot"], []).append(r["place"])
    unnamed = len(set(blocks) - set(weights) | {"*"})
    for source, slots in blocks.items():
        part = weights[source] / total if source in weights and source != "*" else weights["*"] / total / unnamed
        times = sorted(slots)
        # While the source lasts: a block more at its slot, and none until the next one.
        for done, t in enumerate(times):
            assert abs(done + 1 - part * (t + 1)) < 1 and abs(done - part * t) < 1
        assert all(sorted(slots[t]) == list(range(4)) for t in times[:-1])


def test_the_sql_text_deals_many_sources_in_turns_too(spark, tmp_path):
    import duckdb

    from endpulse.llm import oracles
    for weights, n in (({"wiki": 5, "stackoverflow": 2, "*": 13}, 260), ({"wiki": 2, "*": 3}, 20), ({"wiki": 2, "*": 9998}, 30)):
        folder = tmp_path / str(n)
        docs = many_sources(spark, folder, n).where("doc_id is not null").select("doc_id", "source").distinct()
        docs.coalesce(1).write.parquet(str(folder / "once"))
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/once/*.parquet'")
        want = connection.sql(oracles.op10(weights))
        got = lib.scheduled(docs, lib.split_rest(docs, weights), each=True).select(*want.columns)
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)
