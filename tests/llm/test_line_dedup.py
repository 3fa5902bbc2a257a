import random

import pytest
from llm.helpers import rows_of, table, words

from endpulse.llm import line_dedup as lib


def by_hand(docs):
    """docs with distinct ids, in order."""
    seen, gone = set(), {}
    for doc_id, text in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        lines = text.split("\n")
        drop = set()
        for i in range(len(lines) - lib.RUN + 1):
            run = tuple(lines[i:i + lib.RUN])
            if run in seen:
                drop |= set(range(i, i + lib.RUN))
            seen.add(run)
        gone[doc_id] = sorted(drop)
    return sorted((i, t if t is None or not gone[i] else
                   "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i]),
                   0 if t is None else len(t.split("\n")), [] if t is None else gone[i]) for i, t in docs)


def run(spark, docs, extra=None):
    found = lib.dedup_lines(table(spark, docs, extra))
    return sorted((r.doc_id, r.text, r.n_lines, list(r.deleted_lines)) for r in found.collect())


@pytest.mark.parametrize("seed", range(4))
def test_same_as_by_hand(spark, seed):
    rand = random.Random(seed)
    lines = ["", "a", "b", "c d", "é", "a "]
    docs = [(i, "\n".join(rand.choice(lines) + rand.choice(["", "", str(rand.randint(0, 9))])
                          for _ in range(rand.randint(1, 14)))) for i in range(40)]
    block = "one\ntwo\nthree\nfour"
    docs += [(100 + i, f"{i}\n{block}\n{i}x") for i in range(20)]
    docs += [(200, None), (201, ""), (202, "\n"), (203, "\n\n\n\n")]
    assert run(spark, docs, ["line", "gone", "lines"]) == by_hand(docs)


def test_repeated_rows_are_one_document_and_null_ids_come_first(spark):
    text = "x\ny\nz"
    found = lib.dedup_lines(table(spark, [(7, text), (7, text), (None, text), (8, "q\n" + text)]))
    assert rows_of(found, "doc_id", "text") == [(7, ""), (7, ""), (8, "q"), (None, text)]


def test_repeats_inside_one_long_text(spark):
    docs = [(1, "\n".join(["a", "b", "c"] * 3000)), (2, "\n".join(f"l{i}" for i in range(5000)))]
    assert run(spark, docs) == by_hand(docs)


def test_clashing_columns_and_empty_table(spark):
    docs = table(spark, [(1, "a\nb\nc")], ["deleted_lines", "n_lines", "run"])
    assert set(lib.dedup_lines(docs).columns) == set(docs.columns)
    assert lib.dedup_lines(table(spark, [(1, "a")]).where("false")).count() == 0


def short_runs_by_hand(docs, min_words):
    """Deleted lines, with runs of fewer lines of min_words words and whole texts of fewer lines; distinct ids, in order."""
    seen, gone = set(), {}
    for doc_id, text in docs:
        lines, drop = text.split("\n"), set()
        for n in range(1, lib.RUN + 1):
            for i in range(len(lines) - n + 1):
                own = tuple(lines[i:i + n])
                runs = [own] if n == lib.RUN or sum(len(words(x)) for x in own) >= min_words else []
                runs += [("whole", own)] if n < lib.RUN and n == len(lines) else []
                for x in runs:
                    if x in seen:
                        drop |= set(range(i, i + n))
                    seen.add(x)
        gone[doc_id] = sorted(drop)
    return gone


@pytest.mark.parametrize("seed", range(2))
def test_short_runs_of_many_words(spark, seed):
    rand = random.Random(seed)
    lines = ["", "a", "b c", "one two three", "Four, five; six seven", "é e é e é", "1 2 3 4 5 6 7"]
    docs = [(i, "\n".join(rand.choice(lines) + rand.choice(["", "", f" {i}"]) for _ in range(rand.randint(1, 8))))
            for i in range(60)]
    docs += [(100, "unique\na long line of six words"), (101, "x\na long line of six words\ny\nz"),
             (102, "short"), (103, "short"), (104, "two\nlines"), (105, "two\nlines"), (106, "short\nq\nr")]
    rows = lib.dedup_lines(table(spark, docs), min_words=5).collect()
    got = {r["doc_id"]: list(r["deleted_lines"]) for r in rows}
    assert got == short_runs_by_hand(docs, 5)
    assert got[101] == [1] and got[103] == [0] and got[105] == [0, 1] and got[106] == []
