import random

import numpy as np
from llm.helpers import rows_of, table
from pyspark.sql import functions as F

from endpulse.llm import substring_dedup as lib


def prose(rand, n):
    return " ".join("".join(rand.choice("abcdefghéü") for _ in range(rand.randint(2, 9))) for _ in range(n))


def chunks(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    ends = lib.cut_places(raw).tolist()
    return [text.encode()[a:b] for a, b in zip([0, *ends], ends)]


def test_hashes_and_cuts_follow_their_rules():
    rand = random.Random(1)
    raw = np.frombuffer(prose(rand, 200).encode() + b"a" * 900 + rand.randbytes(300), np.uint8)
    h = lib.gear_hashes(raw)
    for i in range(lib.WINDOW, len(raw), 7):
        assert int(h[i]) == sum(int(lib.GEAR[raw[i - j]]) << (2 * j) for j in range(lib.WINDOW)) % 2**32
    ends = lib.cut_places(raw).tolist()
    natural = [i + 1 for i in range(lib.WINDOW + lib.REACH, len(raw) - lib.REACH)
               if h[i] < min(h[i - lib.REACH:i]) and h[i] <= min(h[i + 1:i + 1 + lib.REACH])]
    assert set(natural) <= set(ends) and ends[-1] == len(raw)
    assert max(np.diff([0, *ends])) <= lib.LONGEST
    assert len(ends) > 30 and b"".join(chunks("é" * 500)) == ("é" * 500).encode()


def test_insertions_shift_nothing():
    rand = random.Random(2)
    body = prose(rand, 400)
    plain, moved = chunks(body), chunks(prose(rand, 13) + body)
    assert len(set(plain) & set(moved)) >= len(plain) - 4


def test_passages_of_over_fifty_words_are_found_and_clean_texts_are_not(spark):
    rand = random.Random(3)
    docs, planted = [], set()
    passages = [prose(rand, 51 + i % 20) for i in range(60)]
    for n, passage in enumerate(passages):
        for copy in range(2 + n % 3):
            doc = 1000 + 10 * n + copy
            docs.append((doc, prose(rand, rand.randint(0, 80)) + " " + passage + " " + prose(rand, rand.randint(0, 80))))
            planted.add(doc)
    common = prose(rand, 9)
    docs += [(i, prose(rand, 60) + "\n" + common + "\n" + prose(rand, 40)) for i in range(200)]
    docs += [(5000, "again " * 400), (5001, None), (5002, "")]
    rows = lib.repeated_spans(table(spark, docs, ["start", "place", "digest"])).collect()
    assert {r["doc_id"] for r in rows} == planted
    texts = dict(docs)
    for r in rows:
        span = texts[r["doc_id"]].encode()[r["start"]:r["start"] + r["n_bytes"]]
        assert span.decode(errors="ignore") in f" {passages[(r['doc_id'] - 1000) // 10]} "
        assert r["first_doc_id"] == r["doc_id"] // 10 * 10 and r["kept"] == (r["doc_id"] % 10 == 0)


def test_later_copies_go_and_the_first_stays(spark):
    rand = random.Random(4)
    passage = prose(rand, 120)
    docs = [(i, prose(rand, 30) + " " + passage + " " + prose(rand, 30)) for i in (3, 1, 2)] + [(None, "x"), (9, "lone"), (9, "lone")]
    frame = table(spark, docs, ["row", "__later", "sizes"])
    done = lib.without_repeats(frame)
    assert done.columns == frame.columns and done.count() == len(docs)
    got = {r["doc_id"]: r["text"] for r in done.collect()}
    before = dict(docs)
    assert got[1] == before[1] and got[9] == "lone"
    for i in (2, 3):
        assert len(got[i]) < len(before[i]) - 300 and got[i].startswith(before[i][:100]) and got[i].endswith(before[i][-100:])


def test_repeated_rows_null_ids_long_texts_and_empty_tables(spark):
    rand = random.Random(5)
    text, long = prose(rand, 60), prose(rand, 30_000)
    rows = lib.repeated_spans(table(spark, [(4, text), (4, text), (None, text), (8, long), (9, long)])).collect()
    assert sorted((r["doc_id"], r["first_doc_id"], r["kept"]) for r in rows if r["doc_id"]) == [
        (4, None, False), (4, None, False), (8, 8, True), (9, 8, False)]
    assert [r["n_bytes"] for r in rows if r["doc_id"] == 9] == [len(long.encode())]
    assert lib.repeated_spans(table(spark, [(1, "a")]).where("false")).count() == 0


def spans_by_hand(docs):
    """(doc_id, first_doc_id, start, n_bytes, n_words, kept) of runs of chunks that other rows have too."""
    places = {}
    for row, (doc, text) in enumerate(docs):
        for place, chunk in enumerate(chunks(text)):
            places.setdefault(chunk, []).append((doc, row, place))
    found = []
    for row, (doc, text) in enumerate(docs):
        own = chunks(text)
        common = [len({r for _, r, _ in places[c]}) > 1 for c in own]
        at = 0
        while at < len(own):
            if not common[at]:
                at += 1
                continue
            end = at
            while end < len(own) and common[end]:
                end += 1
            firsts = [min(places[c]) for c in own[at:end]]
            data = text.encode()
            a, b = len(b"".join(own[:at])), len(b"".join(own[:end]))
            word = [x >= 128 or chr(x).isalnum() for x in data]
            n_words = sum(word[i] and (i == 0 or not word[i - 1]) for i in range(a, b))
            if n_words >= lib.MIN_WORDS:
                found.append((doc, min(f[0] for f in firsts), a, b - a, n_words,
                              all(f == (doc, row, at + i) for i, f in enumerate(firsts))))
            at = end
    return sorted(found)


def test_spans_are_those_found_by_hand_whatever_the_length_of_words(spark):
    rand = random.Random(6)
    for longest in (3, 6):
        words = lambda n: " ".join("".join(rand.choice("abcdefgh1é") for _ in range(rand.randint(1, longest)))
                                   for _ in range(n))
        passages = [words(rand.randint(30, 120)) for _ in range(12)]
        # Passages next to each other, cut in two, repeated within a text, in texts that come twice.
        docs = [(i, words(rand.randint(0, 40)) + " " + " ".join(
            p[rand.choice([0, 0, 40]):] for p in rand.sample(passages, rand.randint(0, 3))) + words(rand.randint(0, 40)))
            for i in range(60)]
        docs += [(100, docs[3][1]), (101, passages[0] + " | " + passages[0]), (102, "lone " * 300)]
        got = lib.repeated_spans(table(spark, docs).coalesce(1).sortWithinPartitions("doc_id")).collect()
        want = spans_by_hand(docs)
        assert sorted((r["doc_id"], r["first_doc_id"], r["start"], r["n_bytes"], r["n_words"], r["kept"])
                      for r in got) == want and len(want) > 40


def test_chance_pairs_of_half_a_digest_are_told_apart(spark):
    rand = random.Random(7)
    passage = prose(rand, 60)
    docs = [(i, prose(rand, 50) + " " + (passage if i < 3 else "") + " " + prose(rand, 50)) for i in range(9)]
    stored = lib.chunked(table(spark, docs))
    told = lambda spans: sorted((r["doc_id"], r["start"], r["n_bytes"], r["kept"]) for r in spans.collect())
    want = told(lib._spans(stored, lib.MIN_WORDS))
    assert {d for d, *_ in want} == {0, 1, 2}
    alike = stored.withColumn("digests", F.transform("digests", lambda d: d % 3))
    assert told(lib._spans(alike, lib.MIN_WORDS)) == want
