import random
import zlib

import numpy as np
import pytest
from llm.helpers import SCHEMA, rows_of, table

from endpulse.llm import toxicity as lib

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=600, seed=1):
    rand = random.Random(seed)
    plain = [f"w{i}" for i in range(300)]
    bad = ["vile", "awful", "nasty"]
    docs, labels = [], []
    for i in range(n):
        w = [rand.choice(plain) for _ in range(rand.randint(5, 120))]
        toxic = int(rand.random() < 0.3)
        for _ in range(2 * toxic):
            w.insert(rand.randint(0, len(w)), rand.choice(bad))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_fit_is_the_ftrl_proximal_rule():
    """Against the published update, coordinate by coordinate in plain Python."""
    rand = random.Random(4)
    examples = [(np.array(sorted(rand.sample(range(12), rand.randint(1, 6)))), rand.randint(0, 1)) for _ in range(60)]
    z, n, bias, seen = [0.0] * 12, [0.0] * 12, 0.0, 1.0
    weight = lambda i: 0.0 if abs(z[i]) <= lib.L1 else (
        (1 if z[i] > 0 else -1) * lib.L1 - z[i]) / ((lib.BETA + n[i] ** 0.5) / lib.ALPHA + lib.L2)
    for _ in range(3):
        for at, y in examples:
            w = {i: weight(i) for i in at.tolist()}
            p = 1 / (1 + np.exp(-(sum(w.values()) + bias)))
            g = p - y
            for i in w:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / lib.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
            seen += g * g
            bias -= lib.ALPHA / seen ** 0.5 * g
    found, weights, got = lib.fit(examples, 3)
    assert found.tolist() == [i for i in range(12) if abs(z[i]) > lib.L1]
    assert np.allclose(weights, [weight(i) for i in found.tolist()]) and got == pytest.approx(bias)


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = corpus()
    odd = [(10_000, None), (10_001, ""), (10_002, "vile awful nasty vile"), (None, "vile awful nasty"), (3, docs[3][1])]
    labels += [(10_001, None, None), (None, 0, 1), (5, 1, labels[5][2])]
    found = lib.scored(table(spark, docs + odd, ["score", "weight", "toxic"]), spark.createDataFrame(labels, LABELS))
    assert "toxic" in found.columns and found.columns.count("score") == 1
    rows = found.collect()
    assert len(rows) == len(docs) + len(odd)
    truth = {i: y for i, _, y in labels if y is not None and i is not None}
    held = [r for r in rows if r["doc_id"] in truth and zlib.crc32(b"%d" % r["doc_id"]) % 5 == 0]
    assert len(held) > 80 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[10_000]["score"] == by_id[10_001]["score"] and by_id[10_001]["predicted"] == 0
    assert by_id[10_002]["predicted"] == 1 and by_id[None]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.5) == r["predicted"] for r in rows)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = corpus(200)
    other = [(i, q, 1 - y if zlib.crc32(b"%d" % i) % 5 == 0 else y) for i, q, y in labels]
    run = lambda rows: rows_of(lib.scored(table(spark, docs), spark.createDataFrame(rows, LABELS)), "doc_id", "score")
    assert run(labels) == run(other)


def test_without_labels_or_documents(spark):
    docs, labels = corpus(20)
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in lib.scored(table(spark, docs), none).collect()} == {0.0}
    empty = spark.createDataFrame([], SCHEMA)
    assert lib.scored(empty, spark.createDataFrame(labels, LABELS)).count() == 0
    left = lib.without_toxic(table(spark, docs, ["score"]), none)
    assert left.columns[-1] == "score" and left.count() == 20


def test_sample_is_bounded(spark):
    docs, labels = corpus(300)
    found, _ = lib.train(table(spark, docs), spark.createDataFrame(labels, LABELS), sample=50)
    assert 0 < len(found) <= 1 << lib.BITS


def test_many_rows_of_one_document_are_one_example(spark, monkeypatch):
    """The bound on the fit holds for rows and for features of a row."""
    monkeypatch.setattr(lib, "MOST_FEATURES", 50)
    real = lib.fit
    docs = [(1, f"copy {i} of the same document") for i in range(300)] + [(2, "other words " + "w x y z " * 400), (3, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 4)], "doc_id bigint, toxic int")
    free = [i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5]

    def fit(examples):
        return real(examples) if len(examples) <= len(free) and all(len(f) <= 50 for f, _ in examples) else 1 / 0

    monkeypatch.setattr(lib, "fit", fit)
    assert free
    found, weights = lib.train(table(spark, docs), labels)
    assert len(found) == len(weights) > 0
