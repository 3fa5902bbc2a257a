"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Each source's documents, in a fixed shuffled order, form blocks. A source with
`parts` of the total D gets block j the release time floor(j*D/parts) and the
deadline ceil((j+1)*D/parts); in every slot the released block of the earliest
deadline goes next. As all parts add up to D, the schedule has no idle slot, no
source is ever one block or more ahead of or behind its share, and it repeats
every D slots: so one period, of as many rows as there are parts, is enough for
any number of blocks. Where a source has run out its slots stay empty, and the
others go on in proportion. No row is dropped or repeated.

With `each`, the sources in the share '*' are queues of their own, however many: its
blocks go to them in turn. The k-th block of '*' is less than one block off its time, and
taking turns among m queues adds less than 1 - 1/m of a block, so no source is one
block or more ahead of or behind its equal part of '*' either; no period is needed for it.

Defined results: a null source and every source without weight belong to the
share '*' (there null and '*' are one source); null doc_ids come first; rows equal in doc_id take consecutive places;
other columns are ignored by the order and kept by `mixed`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

BLOCK_DOCS = 16
MAX_PARTS = 10_000
MAX_NAMED = 200
GROUP_ROWS = 1024
REST = "*"


def split_rest(documents: DataFrame, weights: dict[str, int]) -> dict[str, int]:
    """weights with the parts of '*' dealt equally to the sources found that have none of their own.

    All parts are multiplied so that they divide, as far as MAX_PARTS allows; else the shares differ
    by one part. Null is a source too, the only one left in '*'. More than MAX_NAMED sources, or more
    than there are parts, all stay in '*', where `each` gives every one its equal part.
    """
    named = {n: a for n, a in weights.items() if n != REST}
    rest = weights.get(REST, 1)
    source = F.when(F.col("source") != REST, F.col("source")).alias("source")
    found = documents.groupBy(source).count().where(F.col("source").isNull() | ~F.col("source").isin(list(named)))
    n = found.count()
    factor = max(1, min(n // math.gcd(n, rest), MAX_PARTS // (sum(named.values()) + rest)))
    room = rest * factor
    if not n or n > min(room, MAX_NAMED):
        return named | {REST: rest}
    found = found.orderBy(F.desc("count"), F.col("source").asc_nulls_last()).collect()
    names = [REST if r["source"] is None else r["source"] for r in found]
    dealt = {name: room // n + (i < room % n) for i, name in enumerate(names)}
    return {name: a * factor for name, a in named.items()} | dealt


def period(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """One period: source share, parts, total, j, slot, release, deadline. At most MAX_PARTS rows."""
    if any(int(n) != n or n <= 0 for n in weights.values()) or sum(weights.values()) > MAX_PARTS:
        raise ValueError(f"weights must be positive whole parts, {MAX_PARTS} at most together")
    weights = weights if REST in weights else weights | {REST: 1}
    names, total = sorted(weights), sum(weights.values())
    one = spark.range(1, numPartitions=1).select(
        F.array(*[F.lit(n) for n in names]).alias("names"),
        F.array(*[F.lit(weights[n]) for n in names]).alias("parts"))
    parts = F.col("parts")

    def release(j: Column, a: Column) -> Column:
        return F.floor(j * total / a).cast("int")

    def deadline(j: Column, a: Column) -> Column:
        return F.ceil((j + 1) * total / a).cast("int")

    def step(state: Column, t: Column) -> Column:
        released = F.transform(state["done"], lambda n, s: F.when(
            (n < F.get(parts, s)) & (release(n, F.get(parts, s)) <= t),
            F.struct(deadline(n, F.get(parts, s)).alias("deadline"), s.cast("int").alias("s"),
                     n.alias("j"))))
        chosen = F.transform(F.array(F.array_min(released)), lambda p: F.struct(
            F.transform(state["done"], lambda n, s: F.when(s == p["s"], n + 1).otherwise(n)).alias("done"),
            F.concat(state["slots"], F.array(p)).alias("slots")))
        return F.element_at(chosen, 1)

    start = F.struct(
        F.transform(parts, lambda a: F.lit(0)).alias("done"),
        F.array().cast("array<struct<deadline:int,s:int,j:int>>").alias("slots"))
    slots = F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), start, step)["slots"]
    rows = one.select("names", "parts", F.posexplode(slots).alias("slot", "p"))
    share = F.get("parts", F.col("p.s"))
    return rows.select(
        F.get("names", F.col("p.s")).alias("share"), share.alias("parts"), F.lit(total).alias("total"),
        F.col("p.j").alias("j"), F.col("slot").cast("long").alias("at"),
        release(F.col("p.j"), share).alias("release"), F.col("p.deadline").alias("deadline"))


def _numbered(rows: DataFrame, within: list[str], name: str, n: int) -> tuple[DataFrame, DataFrame]:
    """rows with __md5 and __group, and the number of rows before each group among those of `within`.

    The order is that of md5(name); groups have about GROUP_ROWS of the n rows.
    """
    digits = 1
    while GROUP_ROWS * 16 ** digits < n:
        digits += 1
    rows = (rows.withColumn("__md5", F.coalesce(F.md5(F.col(name).cast("string")), F.lit("")))
            .withColumn("__group", F.substring("__md5", 1, digits)))
    # Numbers before each group, in two levels of sums.
    counts = rows.groupBy(*within, "__group").agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__super", F.substring("__group", 1, (digits + 1) // 2))
    inner = Window.partitionBy(*within, "__super").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*within).orderBy("__super").rowsBetween(Window.unboundedPreceding, -1)
    supers = counts.groupBy(*within, "__super").agg(F.sum("__n").alias("__m"))
    supers = supers.withColumn("__base", F.coalesce(F.sum("__m").over(outer), F.lit(0)))
    before = counts.withColumn("__in", F.coalesce(F.sum("__n").over(inner), F.lit(0))).join(
        supers, [*within, "__super"]).select(*within, "__group", (F.col("__base") + F.col("__in")).alias("__before"))
    return rows, before


def _turns(queues: DataFrame, n: int) -> DataFrame:
    """The turn of each queue of '*', from 0."""
    rows, before = _numbered(queues, ["share"], "__queue", n)
    order = Window.partitionBy("share", "__group").orderBy("__md5", "__queue")
    return (rows.withColumn("__row", F.row_number().over(order)).join(before, ["share", "__group"])
            .select("share", "__queue", (F.col("__before") + F.col("__row") - 1).alias("__turn")))


def _ranked(documents: DataFrame, weights: dict[str, int], each: bool) -> tuple[DataFrame, int]:
    """Adds share, __turn and __rank, and how many queues '*' has.

    __rank is the number of a document in its queue, from 0, in the order of md5(doc_id).
    """
    named = [n for n in weights if n != REST]
    share = F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit(REST)) if named else F.lit(REST)
    docs = documents.withColumn("share", F.coalesce(share, F.lit(REST)))
    queue = F.when(F.col("share") == REST, F.coalesce("source", F.lit(REST))) if each else F.lit(None)
    docs = docs.withColumn("__queue", F.coalesce(queue, F.lit("")))
    within = ["share", "__queue"]
    docs, before = _numbered(docs, within, "doc_id", documents.count())
    queues, turns = docs.where(F.col("share") == REST).select(*within).distinct(), 1
    if each and (turns := max(1, queues.count())) > 1:
        # Joined to the groups, of which a large source has many fewer than rows.
        before = before.join(_turns(queues, turns), within, "left")
    else:
        before = before.withColumn("__turn", F.lit(0))
    order = Window.partitionBy(*within, "__group").orderBy("__md5", "doc_id")
    numbered = docs.withColumn("__row", F.row_number().over(order))
    return (numbered.join(before, [*within, "__group"])
            .withColumn("__rank", F.col("__before") + F.col("__row") - 1)
            .drop("__md5", "__group", "__row", "__before", "__queue")), turns


ADDED = ("share", "block", "slot", "release", "deadline", "place")


def _placed(documents: DataFrame, weights: dict[str, int], block_docs: int, each: bool) -> tuple[DataFrame, dict[str, str]]:
    """The new columns beside the old ones, which have other names meanwhile: new name by old name."""
    own = {c: c if c in ("doc_id", "source") else f"__own_{i}" for i, c in enumerate(documents.columns)}
    weights = weights if REST in weights else weights | {REST: 1}
    total = sum(weights.values())
    parts = F.create_map(*[x for n, a in weights.items() for x in (F.lit(n), F.lit(a))])
    docs, turns = _ranked(documents.withColumnsRenamed(own), weights, each)
    block = F.floor(F.col("__rank") / block_docs)
    docs = (docs.withColumn("block", F.when(F.col("share") == REST, block * turns + F.col("__turn")).otherwise(block))
            .withColumn("place", (F.col("__rank") % block_docs).cast("int"))
            .withColumn("__parts", F.element_at(parts, F.col("share")))
            .withColumn("j", (F.col("block") % F.col("__parts")).cast("int"))
            .withColumn("__first", F.floor(F.col("block") / F.col("__parts")) * total))
    # The period has MAX_PARTS rows at most.
    table = period(documents.sparkSession, weights).drop("parts", "total")
    joined = docs.join(F.broadcast(table), ["share", "j"])
    first = F.col("__first")
    return joined.select(
        *own.values(), "share", "block", (first + F.col("at")).alias("slot"),
        (first + F.col("release")).alias("release"), (first + F.col("deadline")).alias("deadline"), "place"), own


def scheduled(documents: DataFrame, weights: dict[str, int], block_docs: int = BLOCK_DOCS,
              each: bool = False) -> DataFrame:
    """documents plus share, block, slot, release, deadline and place (in the block), all from 0.

    Columns of these names in documents are replaced.
    """
    done, own = _placed(documents, weights, block_docs, each)
    return done.select(*[F.col(n).alias(c) for c, n in own.items() if c not in ADDED], *ADDED)


def mixed(documents: DataFrame, weights: dict[str, int], block_docs: int = BLOCK_DOCS,
          each: bool = False) -> DataFrame:
    """The columns and rows of documents, sorted by slot and place: written files hold the mixed order."""
    done, own = _placed(documents, weights, block_docs, each)
    return done.orderBy("slot", "place").select(*[F.col(n).alias(c) for c, n in own.items()])
