"""The prefix trie of conversations that are rebuilt from a base's head and their own rest.

A conversation's rebuilt turns are the first h of its base and its own from the h-th on.
Their texts are never put together: each turn stands for an element of a monoid, a map
x -> a x + b modulo the prime 2**127 - 1 taken from the SHA-256 of role and text, beside its number
of words, and a sequence of turns for the product of its elements in order (the words add up).
Products of a conversation's first turns are computed once, partition by partition, and combined
where a conversation spans several; as the maps have inverses, the product of a rebuilt prefix is

    (product of the base's head) (product of the own first h turns)^-1 (product of the own first j).

Prefixes of one depth and one product are a node. That its turns really are equal is verified: every
member knows the stored turn (conversation and place) that is its last one, and of a node with
several of them role and text must agree, and so must the parents' products; else all is
computed again with other elements (``seed``).

Subtrees need no walk. A conversation is a node's smallest member at all depths behind some f, as
members only get fewer; so each knows what it adds to the nodes on its path: the words of its
turns up to depth f behind the node (somebody smaller has them too), a child where f is the
node's depth or less, and a leaf if it is the smallest that ends in a node where all end.

Defined results: rows without conv_id belong to no conversation; null role or text is empty; turns are
ordered by turn (null first), then role and text, and repeated rows are turns of their own; an
empty table gives no rows; a base that is absent has no turns; other columns are ignored. A
conversation of very many turns is spread over partitions and joins; texts are only digested, and
compared by minimum and maximum in an aggregate that spills, so long ones are read once or twice.
Rows equal in all columns are numbered in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from endpulse.llm.common import write_table
from endpulse.operators.skew import GROUPS, parts

BASES = 20  # conversation c has the base c - c % BASES
HEADS = 4   # and takes crc32(c) % HEADS turns of it
PRIME = (1 << 127) - 1
ID_CHUNK = 1 << 16


def packed(a: int, b: int, words: int) -> bytes:
    return (a << 128 | b).to_bytes(32, "big") + words.to_bytes(8, "big", signed=True)


def unpacked(x: bytes) -> tuple[int, int, int]:
    return (int.from_bytes(x[:16], "big"), int.from_bytes(x[16:32], "big"),
            int.from_bytes(x[32:], "big", signed=True))


ONE = packed(1, 0, 0)


def element(digest: bytes, words: int) -> bytes:
    """The element that stands for a turn of this SHA-256; a is not 0, so it has an inverse."""
    a, b = int.from_bytes(digest[:16], "big"), int.from_bytes(digest[16:], "big")
    return packed(a % (PRIME - 1) + 1, b % PRIME, words)


def times(x: bytes, y: bytes) -> bytes:
    """The product; x's turns stand before y's."""
    if x == ONE:
        return y
    (a, b, n), (c, d, m) = unpacked(x), unpacked(y)
    return packed(a * c % PRIME, (a * d + b) % PRIME, n + m)


def inverse(x: bytes) -> bytes:
    if x == ONE:
        return x
    a, b, n = unpacked(x)
    a = pow(a, -1, PRIME)
    return packed(a, -a * b % PRIME, -n)


def words_of(x: bytes) -> int:
    return int.from_bytes(x[32:], "big", signed=True)


def node_id(depth: int, product: bytes) -> bytes:
    return depth.to_bytes(8, "big") + product[:32]


ROOT = node_id(0, ONE)


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, size: str, own: str, total: int) -> DataFrame:
    """rows with the columns of lookup (one row per key, which holds at most `size` rows of all `total`).

    A key of more than 1/GROUPS of a task's share of rows is spread by the column own, and its lookup row
    repeated; there are fewer such keys than GROUPS for each task, so they are broadcast.
    """
    tasks = GROUPS * parts(rows)
    hot = F.broadcast(lookup.where(F.col(size) * tasks > total).select(
        key, F.ceil(F.col(size) * tasks / max(1, total)).cast("int").alias("groups")))
    salted = rows.join(hot, key, "left").withColumn(
        "salt", F.pmod(F.xxhash64(own), F.coalesce("groups", F.lit(1))).cast("int")).drop("groups")
    copies = F.when(F.col(size) * tasks > total, F.ceil(F.col(size) * tasks / max(1, total))).otherwise(1).cast("int")
    return salted.join(lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), copies - 1))), [key, "salt"]).drop("salt")


# -- stored turns ---------------------------------------------------------------------------------

TURNS = ("conv_id bigint, role string, text string, part int, local bigint, before binary, element binary, "
         "last boolean, edge boolean")


def _number(batches):
    """Place of each row in its conversation's rows of this partition, and the product before it.

    last: the last of these rows; edge: of the first or the last conversation of the partition, and last.
    A batch waits for the first row of the next one.
    """
    conv, place, product, segment, waiting = None, 0, ONE, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns, starts = [[], [], [], []], []
        for c, words, digest in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
            starts.append(c != conv and conv is not None)
            if c != conv:
                segment += conv is not None
                conv, place, product = c, 0, ONE
            e = element(digest, words)
            for column, value in zip(columns, (place, product, e, segment == 0)):
                column.append(value)
            place, product = place + 1, times(product, e)
        if waiting:
            yield _flagged(*waiting, starts[0], False)
        waiting = (batch, columns, starts)
    if waiting:
        yield _flagged(*waiting, True, True)


def _flagged(batch, columns, starts, next_starts, final):
    last = starts[1:] + [next_starts]
    edge = [a and b for a, b in zip(last, columns[3])]
    edge[-1] = edge[-1] or final
    kinds = [pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in (0, 1, 2, 5)] + [pa.array(c, k) for c, k in zip(columns, kinds)]
        + [pa.array(last), pa.array(edge)], names=[c.split()[0] for c in TURNS.split(", ")])


def stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """The turns, with idx, their place in the conversation, and the product before it: base times before.

    last: the last turn of the conversation, in whichever partition it stands.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", role.alias("role"), text.alias("text"), "turn")
    # Texts are cut for the sample that finds the ranges; their order is that of the whole texts all the same.
    ranged = rows.repartitionByRange(
        "conv_id", F.col("turn").asc_nulls_first(), F.substring("role", 1, 32), F.substring("text", 1, 32))
    ranged = ranged.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    told = F.concat(F.lit(f"{seed}:"), F.length("role").cast("string"), F.lit(":"), "role", "text")
    ranged = ranged.select(
        "conv_id", "role", "text", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.unhex(F.sha2(told, 256)).alias("digest"), F.spark_partition_id().alias("part"))
    turns = write_table(ranged.mapInArrow(_number, TURNS), "turns")

    # A conversation spans partitions only from the last of one on; so two rows per partition tell all.
    edges = turns.where("edge").select("conv_id", "part", "local", "before", "element").orderBy("part", "conv_id").collect()
    starts, conv, n, product = [], None, 0, ONE
    for row, following in zip(edges, [*edges[1:], None]):
        if row.conv_id != conv:
            conv, n, product = row.conv_id, 0, ONE
        goes_on = following is not None and following.conv_id == conv
        if n or goes_on:
            starts.append((conv, row.part, n, bytearray(product), goes_on))
        n, product = n + row.local + 1, times(product, times(bytes(row.before), bytes(row.element)))
    starts = conversations.sparkSession.createDataFrame(
        starts, "conv_id bigint, part int, base_n bigint, base binary, goes_on boolean")
    return turns.join(F.broadcast(starts), ["conv_id", "part"], "left").select(
        "conv_id", "role", "text", (F.coalesce("base_n", F.lit(0)) + F.col("local")).alias("idx"),
        F.coalesce("base", F.lit(ONE)).alias("base"), "before", "element",
        (F.col("last") & ~F.coalesce("goes_on", F.lit(False))).alias("last"))


# -- members of nodes -----------------------------------------------------------------------------

HEAD = pa.struct([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("ends", pa.bool_()),
                  ("words", pa.int64()), ("words_before", pa.int64())])
PLANS = ("conv_id bigint, n bigint, h bigint, taken bigint, factor binary, head array<struct<node: binary, "
         "parent: binary, depth: bigint, ends: boolean, words: bigint, words_before: bigint>>")
MEMBERS = ("conv_id bigint, own_at bigint, node binary, parent binary, depth bigint, ends boolean, words bigint, "
           "words_before bigint")


def _plan(batches):
    """Per conversation: turns taken from the base, factor in front of its own products, and nodes in the head."""
    for batch in batches:
        out = [[] for _ in range(6)]
        for base_id, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            first, sizes, heads = {}, {}, {}
            for t in turns:  # sorted by conversation and place
                sizes[t["conv_id"]] = t["idx"] + 1
                heads[t["conv_id"]] = t["h"]
                if t["element"] is not None:
                    first.setdefault(t["conv_id"], []).append(t["element"])
            for conv, n in sizes.items():
                h = heads[conv]
                theirs = first.get(base_id, [])[:h]
                product, head = ONE, []
                for d, e in enumerate(theirs, 1):
                    longer = times(product, e)
                    head.append({"node": node_id(d, longer), "parent": node_id(d - 1, product), "depth": d,
                                 "ends": d == len(theirs) and n <= h, "words": words_of(longer),
                                 "words_before": words_of(product)})
                    product = longer
                skipped = ONE
                for e in first[conv][:h]:
                    skipped = times(skipped, e)
                for column, value in zip(out, (conv, n, h, len(theirs), times(product, inverse(skipped)), head)):
                    column.append(value)
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(HEAD)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                         names=["conv_id", "n", "h", "taken", "factor", "head"])


def _rest(batches):
    """Nodes of a conversation's own turns behind its head."""
    for batch in batches:
        out = [[] for _ in range(5)]
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                   for c in ("idx", "base", "before", "element", "h", "taken", "factor"))
        for idx, base, before, e, h, taken, factor in zip(*columns):
            product = times(times(factor, base), before)
            longer, depth = times(product, e), taken + idx - h + 1
            for column, value in zip(out, (node_id(depth, longer), node_id(depth - 1, product), depth,
                                           words_of(longer), words_of(product))):
                column.append(value)
        conv, idx, ends = (batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "idx", "last"))
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        node, parent, depth, words, before = (pa.array(c, k) for c, k in zip(out, kinds))
        yield pa.RecordBatch.from_arrays([conv, idx, node, parent, depth, ends, words, before],
                                         names=[c.split()[0] for c in MEMBERS.split(", ")])


def members_of(turns: DataFrame, bases: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conversations with n, h and taken, members: a row per conversation and depth from 1 on).

    own_at is the place of the member's last turn among its own; null in a head, whose turns are the
    last ones of the base's own rows of the same node.
    """
    base_id = (F.col("conv_id") - F.col("conv_id") % bases).alias("base_id")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    first = turns.where((F.col("idx") < heads - 1) | F.col("last")).select(
        base_id, F.struct("conv_id", "idx", F.when(F.col("idx") < heads - 1, F.col("element")).alias("element"), h)
        .alias("turn"))
    # A base has fewer than 2 * bases conversations (those around 0), each with at most `heads` rows here.
    first = first.groupBy("base_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    plans = write_table(first.mapInArrow(_plan, PLANS), "plans")
    rows = turns.select("conv_id", "idx", "base", "before", "element", "last")
    total = plans.agg(F.sum("n")).first()[0] or 0
    rest = spread_join(rows, plans.drop("head"), "conv_id", "n", "idx", total).where("idx >= h").mapInArrow(_rest, MEMBERS)
    head = plans.select("conv_id", F.explode("head").alias("x")).select(
        "conv_id", F.lit(None).cast("long").alias("own_at"), "x.node", "x.parent", "x.depth", "x.ends", "x.words",
        "x.words_before")
    return plans.drop("head", "factor"), write_table(rest.unionByName(head), "members")


def nodes_of(members: DataFrame) -> DataFrame:
    """Per node: its smallest member (first), its number of members and of those that end there, and what must agree."""
    return members.groupBy("node").agg(
        F.min("conv_id").alias("first"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"),
        F.count_if("ends").alias("n_ends"), F.count("own_at").alias("n_own"),
        F.min("parent").alias("parent"), F.max("parent").alias("last_parent"))


def clashes(turns: DataFrame, told: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes whose members differ: in their parents, or in role or text of their last turns."""
    refs = told.where("own_at is not null and n_own > 1").select("node", "conv_id", F.col("own_at").alias("idx"))
    last = refs.join(turns.select("conv_id", "idx", "role", "text"), ["conv_id", "idx"])
    differ = [F.min(c) != F.max(c) for c in ("role", "text")]
    differing = last.groupBy("node").agg((differ[0] | differ[1]).alias("differ")).where("differ").select("node")
    return nodes.where("parent <> last_parent").select("node").unionAll(differing)


# -- what is told of nodes ------------------------------------------------------------------------

def _id_chunks(batches):
    """Comma-joined runs of sorted ids, one or more rows per node and partition."""
    node, ids, number = None, [], 0

    def row():
        return pa.RecordBatch.from_pydict(
            {"node": [node], "number": [number], "ids": [",".join(map(str, ids))]},
            schema=pa.schema([("node", pa.binary()), ("number", pa.int64()), ("ids", pa.string())]))

    for batch in batches:
        for n, c in zip(*(x.to_pylist() for x in batch.columns)):
            if ids and (n != node or len(ids) == ID_CHUNK):
                yield row()
                ids, number = [], number + 1
            node = n
            ids.append(c)
    if ids:
        yield row()


def _id_digests(batches):
    node, digest = None, None
    for batch in batches:
        out = []
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n == node:
                digest.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((node, digest.hexdigest()))
            node, digest = n, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()),
                                          pa.array([o[1] for o in out], pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])],
                                         names=["node", "ends_sha256"])


def id_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's conv_ids (node, conv_id), ascending and comma-joined.

    Ids are sorted and joined range by range, so the one task of a node with very many reads a few long rows.
    """
    chunks = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _id_chunks, "node binary, number bigint, ids string")
    chunks = write_table(chunks.withColumn("part", F.spark_partition_id()), "id-chunks")
    return chunks.repartition("node").sortWithinPartitions("node", "part", "number").select("node", "ids").mapInArrow(
        _id_digests, "node binary, ends_sha256 string")


def trie(conversations: DataFrame, bases: int = BASES, heads: int = HEADS) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    if bases < 1 or heads < 1:
        raise ValueError("bases and heads must be positive")
    spark = conversations.sparkSession
    for seed in count():
        turns = stored_turns(conversations, seed)
        plans, members = members_of(turns, bases, heads)
        nodes = write_table(nodes_of(members), "nodes")
        # What members know of their nodes; of a single member only where it ends.
        known = nodes.select("node", "first", "n_convs", "n_own", (F.col("n_ends") == F.col("n_convs")).alias("childless"))
        told = write_table(spread_join(members.drop("parent"), known, "node", "n_convs", "conv_id", members.count()).where(
            (F.col("n_convs") > 1) | F.col("ends")), "told-members")
        if clashes(turns, told, nodes).isEmpty():
            break

    # f: the last depth where somebody smaller has the same prefix; its words, and who that is.
    behind = F.when(F.col("first") != F.col("conv_id"), F.struct("depth", "words", "first"))
    leads = F.col("ends") & F.col("childless") & (F.col("first") == F.col("conv_id"))
    paths = told.groupBy("conv_id").agg(
        F.max(behind).alias("f"), F.max(F.when(F.col("ends"), F.col("depth"))).alias("length"),
        F.max(leads.cast("long")).alias("leaf"), F.count("*").alias("n_told"))
    paths = write_table(paths.select(
        "conv_id", F.coalesce("f.depth", F.lit(0)).alias("f"), F.coalesce("f.words", F.lit(0)).alias("f_words"),
        F.col("f.first").alias("f_first"), "length", "leaf", "n_told"), "paths")

    shared = told.where("n_convs > 1").select("node", "conv_id", "depth", "words_before")
    saved = F.when(F.col("depth") <= F.col("f"), F.col("f_words") - F.col("words_before")).otherwise(0)
    sums = spread_join(shared, paths, "conv_id", "n_told", "depth", told.count()).groupBy("node").agg(
        F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens"),
        F.count_if((F.col("f") <= F.col("depth")) & (F.col("depth") < F.col("length"))).alias("n_children"))

    root = F.lit(ROOT)
    ends = members.where("ends").select("node", "conv_id").unionAll(
        plans.where((F.col("taken") == 0) & (F.col("n") <= F.col("h"))).select(root.alias("node"), "conv_id"))
    everyone = plans.agg(F.min("conv_id").alias("first"), F.count("*").alias("n")).first()  # one row
    below = paths.agg(F.sum("leaf"), F.sum("f_words"), F.count_if(F.col("f") == 0)).first()
    top = [] if not everyone.n else [(
        bytearray(ROOT), everyone.first, 0, None, everyone.n, below[2] or 0, max(1, below[0] or 0), below[1] or 0)]
    top = spark.createDataFrame(top, "node binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
                                     "n_children bigint, n_leaves bigint, saved_tokens bigint")

    # The parent's smallest member is this node's own one, or the one that is smaller last.
    leaders = paths.join(plans.select("conv_id", (F.col("n") + F.col("taken")).alias("most")), "conv_id").select(
        F.col("conv_id").alias("first"), "f", "f_first", "most")
    total = members.count()
    placed = spread_join(nodes.select("node", "first", "depth", "n_convs", "n_ends"), leaders, "first", "most", "depth", total)
    parent = F.when(F.col("depth") == 1, F.lit(everyone.first).cast("long")).when(
        F.col("f") == F.col("depth") - 1, F.col("f_first")).otherwise(F.col("first"))
    single = F.when(F.col("n_convs") > F.col("n_ends"), 1).otherwise(0)
    filled = placed.join(sums, "node", "left").select(
        "node", F.col("first").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", single).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"))
    nothing = hashlib.sha256(b"").hexdigest()
    return filled.unionAll(top).join(id_digests(ends), "node", "left").drop("node").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
