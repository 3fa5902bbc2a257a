import hashlib
import random

from hypothesis import given, settings, strategies as st
from llm.helpers import rows_of
from pyspark.sql import functions as F

from endpulse.llm import chat as lib

ROWS = "conv_id bigint, turn bigint, role string, text string"
MESSAGES = "conv string, conv_id bigint, node bigint, parent bigint, role string, text string, score double"
ROLES = ["user", "assistant", "system", "tool>>", "", "<</SYS>>\\"]


def escape(text):
    return "".join("\\" + c if c in "\\<>[]" else c for c in text)


def by_hand(turns):
    out, spans = "<s>", []
    for role, text in turns:
        if role == "user":
            out += f"[INST] {escape(text)} [/INST]"
        elif role == "assistant":
            spans.append((len(out), len(out) + len(escape(text))))
            out += escape(text) + "</s>"
        else:
            out += f"<<SYS {escape(role)}>>{escape(text)}<</SYS>>"
    return out, spans


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), st.text(alphabet="ab \\<>[]/sINTY\n😀", max_size=12))))
def test_parse_is_the_inverse(turns):
    assert lib.parse(by_hand(turns)[0]) == turns


def digest(rows):
    return hashlib.sha256("".join(rows).encode()).hexdigest()


def test_contract_columns(spark):
    rand = random.Random(1)
    told = "</s>[INST] ok [/INST]"
    texts = [told, "", "plain", "é😀\n", "\\", "[/INST]</s><s>", "<<SYS x>>y<</SYS>>", " lead and trail "]
    rows = [(-1, 0, "user", told), (-1, 1, "assistant", told)]
    for c in range(30):
        rows += [(c, t, rand.choice(ROLES[:3]), rand.choice(texts)) for t in range(rand.randint(1, 9))]
    rows += [(90, 0, "assistant", None), (90, 1, None, "x"), (None, 3, "assistant", "no id"), (91, 0, "assistant", "twice"),
             (91, 0, "assistant", "twice"), (92, None, "user", "no turn"), (93, 0, "user", "long " * 50_000)]
    rows += [(94, t, ROLES[t % 2], f"t{t}") for t in range(300)]
    frame = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit(1) for c in ("node", "parent", "score", "path")})
    want = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        learned = [t for r, t in turns if r == "assistant"]
        want.append((conv, len(turns), digest(f"{r}\n{t}\n" for r, t in turns), sum(map(len, learned)), digest(learned),
                     len(by_hand(turns)[0])))
    found = lib.read_back(lib.formatted(lib.linear_tree(frame))).drop("path")
    assert rows_of(found, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars") == sorted(
        want, key=repr)


def paths_by_hand(nodes, n_paths):
    parent = {n: p if p in {m for m, _, _ in nodes} else None for n, p, _ in nodes}
    score = {n: s for n, _, s in nodes}
    found = []
    for leaf in set(parent) - {p for _, p, _ in nodes if p is not None}:
        path, seen = [leaf], {leaf}
        while parent[path[-1]] is not None and parent[path[-1]] not in seen:
            path.append(parent[path[-1]])
            seen.add(path[-1])
        if parent[path[-1]] is None:
            found.append((-sum(score[n] for n in path), -len(path), leaf, path[::-1]))
    return [p[3] for p in sorted(found)[:n_paths]]


def test_best_branches_of_trees(spark):
    rand = random.Random(6)
    rows, want = [], []
    for c in range(25):
        nodes = [(n, rand.choice([None] + list(range(n))) if n else None, float(rand.randint(-2, 3))) for n in
                 range(rand.randint(1, 25))]
        if c == 3:
            nodes = [(n, n - 1 if n else None, 1.0) for n in range(70)]
        if c == 4:
            nodes += [(50, 51, 9.0), (51, 50, 9.0), (60, 999, 0.0), (61, 60, 0.5)]
        rows += [(str(c), c, n, p, "user", f"m{n}", s) for n, p, s in nodes]
        want += [(str(c), r + 1, [f"m{n}" for n in path]) for r, path in enumerate(paths_by_hand(nodes, 2))]
    rand.shuffle(rows)
    found = lib.formatted(spark.createDataFrame(rows, MESSAGES), n_paths=2).collect()
    got = [(r["conv"], r["path"], [t for _, t in lib.parse(r["formatted"])]) for r in found]
    assert sorted(got) == sorted(want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    assert lib.read_back(lib.formatted(lib.linear_tree(empty))).count() == 0
