import hashlib
import random
import re
import zlib

import pytest
from llm.helpers import rows_of

from endpulse.llm import prefix_trie as lib

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    """[(conv_id, turn, role, text)]: the nodes, from rebuilt sequences."""
    own = {}
    for conv, turn, role, text in sorted(
            rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20 * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(c - rest, [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[x] for x in below) if below else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        saved[prefix] = sum(saved[x] for x in below) + (len(members[prefix]) - 1) * words
    out = []
    for prefix, convs in members.items():
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(prefix))
        out.append((min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs),
                    len(children.get(prefix, [])), leaves[prefix], saved[prefix],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return rows_of(lib.trie(frame), *COLUMNS)


def random_rows(seed, convs, longest=7):
    rand = random.Random(seed)
    texts = ["", "one", "one two", "a b  c\n", "\x1c x\xa0y", None]
    return [(c, rand.choice([t, t, None, 3]), rand.choice(["user", "assistant", None]), rand.choice(texts))
            for c in convs for t in range(rand.choice([1, 2, 3, longest]))]


def test_products_are_associative_and_have_inverses():
    rand = random.Random(2)
    x, y, z = (lib.element(rand.randbytes(32), n) for n in (1, 0, 7))
    assert lib.times(lib.times(x, y), z) == lib.times(x, lib.times(y, z))
    assert lib.times(x, y) != lib.times(y, x)
    assert lib.times(x, lib.inverse(x)) == lib.ONE == lib.times(lib.inverse(x), x)
    assert lib.times(lib.ONE, x) == x == lib.times(x, lib.ONE)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_rebuilt_sequences(spark, seed):
    rows = random_rows(seed, [*range(0, 70), *range(-45, 0), 10**15, 10**15 + 7])
    rows += [(None, 1, "user", "belongs to none"), (5, 0, "user", "again"), (5, 0, "user", "again")]
    assert got(spark, rows) == by_hand(rows)


def test_one_conversation_of_many_turns_and_many_copies(spark):
    """A conversation over all partitions, its copy, a first turn and a whole conversation that very many share."""
    rows = [(c, t, "user", f"turn {t}") for c in (40, 80) for t in range(150)]
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(3)]
    rows += [(c, t, "user", "same" if t < 4 else f"own {c}") for c in range(200, 260) for t in range(5 if c % 3 else 4)]
    assert got(spark, rows, parts=8) == by_hand(rows)


def test_only_the_last_turn_ends_a_conversation_that_spans_partitions(spark):
    """Small partitions, as large tables have them: Spark does not put them together."""
    rows = [(c, t, "user", f"turn {t}") for c in (40, 80) for t in range(60)] + random_rows(5, range(100, 150))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        turns = lib.stored_turns(spark.createDataFrame(rows, SCHEMA), 0)
        assert turns.where("last").count() == len({r[0] for r in rows})
        assert got(spark, rows, parts=8) == by_hand(rows)
    finally:
        spark.conf.set(name, before)


def test_clashing_elements_are_found_and_others_taken(spark, monkeypatch):
    """Turns that look alike to the first elements are told apart by their texts."""
    rows = random_rows(7, range(60))
    seeds = []
    real, alike = lib.stored_turns, lib.element(bytes(range(32)), 1)

    def blind(conversations, seed):
        seeds.append(seed)
        if seed:
            return real(conversations, seed)
        with monkeypatch.context() as patch:
            patch.setattr(lib, "element", lambda digest, words: alike)
            return real(conversations, seed)

    monkeypatch.setattr(lib, "stored_turns", blind)
    assert got(spark, rows) == by_hand(rows)
    assert seeds == [0, 1]


def test_no_rows_and_turnless_conversations(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 0, "user", "none")]) == []
    rows = [(c, 0, "user", "short") for c in range(1, 40) if c != 20]  # no bases: heads are cut off
    assert any(zlib.crc32(str(c).encode()) % 4 for c, *_ in rows)
    assert got(spark, rows) == by_hand(rows)
    rows = [(c, 0, None, None) for c in range(1, 40) if zlib.crc32(str(c).encode()) % 4 and c != 20]
    assert got(spark, rows) == by_hand(rows) and len(by_hand(rows)) == 1


def test_extra_columns_and_long_texts(spark):
    from pyspark.sql import functions as F
    rows = [(0, 0, "user", "w " * 200_000), (1, 0, "user", "w " * 200_000), (1, 1, "assistant", "end")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("other") for c in ("node", "part", "idx", "n", "words", "base")})
    assert rows_of(lib.trie(frame), *COLUMNS) == by_hand(rows)
