"""Chat formatting of reply trees.

Messages are nodes with a parent. Iterative self-joins double the distance to the
ancestor that each node knows, so a tree of depth d takes log2(d) joins: they give
every leaf the score of its path (the sum of its messages' scores), and lead from
the chosen leaves back to all nodes of their paths. Branches are ranked by score,
then by length, then by the smaller leaf; each chosen path is one conversation.

Template: <s>, then per turn `[INST] text [/INST]` for a user, `text</s>` for an
assistant, and `<<SYS role>>text<</SYS>>` for any other role. In texts and roles
a backslash goes before each of \\ < > [ ], so no control string can arise in
them, and removing it gives the text back. The loss mask is the spans of the
assistants' texts, as places of code points in the formatted conversation.

Defined results: null text and role are empty; a null conv_id is a conversation
of its own; a parent that does not exist makes its node a root; nodes of a reply
cycle are on no path; repeated rows are turns of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from endpulse.llm.common import cut

TURN = re.compile(
    r"\[INST\] (?P<user>(?:[^\\<>\[\]]+|\\.)*+)\[/INST\]"
    r"|<<SYS (?P<role>(?:[^\\<>\[\]]+|\\.)*+)>>(?P<other>(?:[^\\<>\[\]]+|\\.)*+)<</SYS>>"
    r"|(?P<assistant>(?:[^\\<>\[\]]+|\\.)*+)</s>", re.S)
MARK = re.compile(r"\\(.)", re.S)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<>\[\]])", r"\\$1")


def linear_tree(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a tree without branches: conv, node, parent, role, text, score."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = conversations.select(conv.alias("conv"), "conv_id", "turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(order).cast("long")).select(
        "conv", "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.lit(0.0).alias("score"))


def chosen_paths(messages: DataFrame, n_paths: int = 1) -> DataFrame:
    """conv, path (rank from 1), depth (from 1), node: the best root-to-leaf paths of each conversation."""
    nodes = cut(messages.select("conv", "node", "parent", "score"))
    known = nodes.select("conv", F.col("node").alias("parent"), F.lit(True).alias("there")).distinct()
    step = nodes.join(known, ["conv", "parent"], "left").select(
        "conv", "node", F.when(F.col("there"), F.col("parent")).alias("up"),
        F.col("score").alias("total"), F.lit(1).cast("long").alias("depth"))
    levels, most = [], nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    step = cut(step)
    while True:
        climbing = step.where(F.col("up").isNotNull())  # the others know their root already
        if climbing.isEmpty() or 1 << len(levels) > most:
            break
        levels.append(climbing.select("conv", "node", "up"))
        far = step.select("conv", F.col("node").alias("up"), F.col("up").alias("up2"),
                          F.col("total").alias("total2"), F.col("depth").alias("depth2"))
        climbed = climbing.join(far, ["conv", "up"]).select(
            "conv", "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"),
            (F.col("depth") + F.col("depth2")).alias("depth"))
        step = cut(step.where(F.col("up").isNull()).unionAll(climbed))
    parents = nodes.where(F.col("parent").isNotNull()).select("conv", F.col("parent").alias("node")).distinct()
    leaves = step.where(F.col("up").isNull()).join(parents, ["conv", "node"], "left_anti")
    rank = Window.partitionBy("conv").orderBy(F.desc("total"), F.desc("depth"), "node")
    path = cut(leaves.withColumn("path", F.row_number().over(rank)).where(F.col("path") <= n_paths)
               .select("conv", "path", "node", "depth"))
    for number in reversed(range(len(levels))):
        above = path.join(levels[number], ["conv", "node"]).select(
            "conv", "path", F.col("up").alias("node"), (F.col("depth") - (1 << number)).alias("depth"))
        path = cut(path.unionAll(above))  # or each level would hold the plan of the last one twice
    return path


def formatted(messages: DataFrame, n_paths: int = 1) -> DataFrame:
    """conv, conv_id, path, n_turns, formatted text and loss (array of start and end) of each chosen path."""
    messages = cut(messages)
    turns = chosen_paths(messages, n_paths).join(messages, ["conv", "node"])
    text, role = escaped(F.col("text")), escaped(F.col("role"))
    turns = turns.withColumn("body", text).withColumn(
        "head", F.when(F.col("role") == "user", F.lit("[INST] ")).when(F.col("role") == "assistant", F.lit(""))
        .otherwise(F.concat(F.lit("<<SYS "), role, F.lit(">>")))).withColumn(
        "tail", F.when(F.col("role") == "user", F.lit(" [/INST]")).when(F.col("role") == "assistant", F.lit("</s>"))
        .otherwise(F.lit("<</SYS>>")))
    turns = turns.withColumn("piece", F.concat("head", "body", "tail"))
    before = Window.partitionBy("conv", "path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    lo = F.lit(len("<s>")) + F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.char_length("head")
    turns = turns.withColumn("lo", lo).withColumn("span", F.when(
        F.col("role") == "assistant", F.struct(F.col("lo").alias("start"), (F.col("lo") + F.char_length("body")).alias("end"))))
    rows = turns.groupBy("conv", "path").agg(
        F.first("conv_id").alias("conv_id"), F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("depth", "piece", "span"))).alias("turns"))
    return rows.select(
        "conv", "conv_id", "path", "n_turns",
        F.concat(F.lit("<s>"), F.array_join(F.transform("turns", lambda t: t["piece"]), "")).alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss"))


def parse(formatted_text: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted conversation."""
    if not formatted_text.startswith("<s>"):
        raise ValueError("no start mark")
    out, at = [], len("<s>")
    while at < len(formatted_text):
        found = TURN.match(formatted_text, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        at = found.end()
        if found["user"] is not None:
            out.append(("user", MARK.sub(r"\1", found["user"][:-1])))  # without the template's space
        if found["assistant"] is not None:
            out.append(("assistant", MARK.sub(r"\1", found["assistant"])))
        if found["role"] is not None:
            out.append((MARK.sub(r"\1", found["role"]), MARK.sub(r"\1", found["other"])))
    return out


def read_back(conversations: DataFrame) -> DataFrame:
    """conv_id, path, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the output."""
    def read(batches):
        for batch in batches:
            rows = []
            for conv, path, text, loss in zip(*(c.to_pylist() for c in batch.columns)):
                turns, learned = parse(text), hashlib.sha256()
                whole, n = hashlib.sha256(), 0
                for role, body in turns:
                    whole.update(f"{role}\n{body}\n".encode())
                for span in loss:
                    part = MARK.sub(r"\1", text[span["start"]:span["end"]])
                    learned.update(part.encode())
                    n += len(part)
                rows.append((conv, path, len(turns), whole.hexdigest(), n, learned.hexdigest(), len(text)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ("conv_id", "path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))

    return conversations.select("conv_id", "path", "formatted", "loss").mapInArrow(
        read, "conv_id bigint, path int, n_turns bigint, turns_sha256 string, loss_chars bigint, "
              "loss_sha256 string, formatted_chars bigint")
