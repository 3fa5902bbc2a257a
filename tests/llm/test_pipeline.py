import numpy as np
import pytest
from llm.helpers import rows_of, words
from pyspark.sql import functions as F

import corpus_pipeline
from endpulse.llm import minhash, toxicity

SF_DIR = "/root/testdata/sf0.01"
NAMES = [n for n, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage leaves, after documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(n))
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_in_order(stages):
    assert NAMES == ["toxicity", "near-duplicates", "decontamination", "mixing", "token files"]
    for frame in stages[1:-1]:
        assert frame.schema == stages[0].schema


def test_toxic_documents_go_and_only_they(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    want = toxicity.scored(stages[0], labels).where("predicted = 0").select(*stages[0].columns)
    assert rows_of(stages[1], "doc_id") == rows_of(want, "doc_id") and stages[1].count() < stages[0].count()


def test_one_of_each_class_stays(stages):
    done = minhash.near_duplicates(stages[1])
    assert rows_of(stages[2], "doc_id") == rows_of(done.where("stays"), "doc_id")
    assert stages[2].select("text").distinct().count() == stages[2].count()


def test_no_benchmark_passage_is_left(spark, stages):
    grams = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = words(r["text"])
        grams |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))}

    def bad(text):
        w, hit = words(text), set()
        for i in range(len(w) - 12):
            if tuple(w[i:i + 13]) in grams:
                hit |= set(range(i, i + 13))
        return bool(hit) and 20 * len(hit) >= len(w)

    before = {r["doc_id"]: r["text"] for r in stages[2].select("doc_id", "text").collect()}
    assert {r["doc_id"] for r in stages[3].collect()} == {i for i, t in before.items() if not bad(t)}
    assert len(before) > stages[3].count()


def test_mixture_is_the_order_of_the_token_files(spark, stages):
    assert rows_of(stages[4]) == rows_of(stages[3])
    order = [r["doc_id"] for r in stages[4].select(
        "doc_id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).orderBy("f", "i").collect()]
    tokens = stages[5].orderBy("start").collect()
    assert [r["doc_id"] for r in tokens] == order != sorted(order)
    assert np.cumsum([0] + [r["n_tokens"] for r in tokens])[:-1].tolist() == [r["start"] for r in tokens]


def test_run(spark, stages):
    assert rows_of(corpus_pipeline.run(spark, SF_DIR), "doc_id", "n_tokens", "ids_crc32") == rows_of(
        stages[5], "doc_id", "n_tokens", "ids_crc32")


def test_stages_with_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, ties and repeated rows, and columns of clashing names."""
    rows = [(1, "a few words of text", "en", "src0", 5), (1, "a few words of text", "en", "src0", 5), (2, None, None, None, None),
            (3, "", "en", "", 0), (None, "no id here at all", "en", "src1", 1), (None, "no id here at all", "en", "src1", 1),
            (4, "long words " * 60_000, "en", "src0", None), (5, "line\n" * 50, "fr", "src9", 250), (6, "?!", "en", "src0", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = ["score", "predicted", "tid", "label", "slot", "share", "row", "n_hit", "start", "j", "__rank", "__key", "n_lines",
             "__right___key", "hash"]
    docs = docs.withColumns({c: F.lit(c) for c in extra})
    for empty in (False, True):
        frame = docs.where("false") if empty else docs
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{empty}-{n}")
            frame.write.parquet(path)
            before = spark.read.parquet(path)
            frame = stage(spark, before, SF_DIR)
            if n < 4:
                assert frame.columns == docs.columns
                assert all(r[c] == c for r in frame.collect() for c in extra)
            if n == 1 and not empty:
                assert rows_of(frame, "doc_id") == sorted([(1,), (2,), (4,), (5,), (6,), (None,)], key=repr)
        got = rows_of(frame, "doc_id", "n_tokens")
        assert got == [] if empty else len(got) == 6 and (2, 1) in got
