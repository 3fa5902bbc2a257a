"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

Largest inner products become smallest distances when each vector gets one more
component, the root of (largest squared length - own squared length), and each query a zero.
The tree is fitted on at most `sample` vectors (bounded in bytes too); every vector
is then assigned to a leaf. A query visits leaves in the order of a priority
queue over the centres on its way. How many leaves it visits is calibrated: a
bounded set of queries is answered exactly against all rows, and the visits are
the fewest that find RECALL of their neighbours.

Neighbouring leaves form groups of about BLOCK_BYTES of vectors; a query goes once to
each group with the list of its leaves there. Groups are worked on in blocks of
about BLOCK_BYTES of vectors by BLOCK_QUERIES queries, so a leaf that holds a third of
all vectors, or that a third of all queries visit, is the work of many tasks. Each
block sends its best k per query only.

Defined results: vectors that are null, zero, hold null or non-finite components,
have no vec_id, or not the most frequent length (the larger of equals) take no
part; a candidate of the query's own vec_id is the query; ties go to the smaller
vec_id; with fewer than k candidates all are returned; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from endpulse.llm.common import write_table

K = 20
SAMPLE, SAMPLE_BYTES = 20_000, 32 << 20
BRANCHES, LEAF = 12, 40
CALIBRATION = 256
RECALL = 0.97
BLOCK_BYTES, BLOCK_QUERIES = 8 << 20, 2048  # vectors and queries of a block
AT_ONCE = 256  # queries multiplied at once
SEED = 7


class Tree:
    """Centres of all nodes, their children and the leaf numbers."""

    def __init__(self, points: np.ndarray):
        self.centres, self.children, self.leaf, self.n_leaves = [], [], [], 0
        self._grow(points, np.random.default_rng(SEED), 0)
        self.centres = np.array(self.centres)

    def _grow(self, points, random, depth) -> int:
        me = len(self.centres)
        self.centres.append(points.mean(axis=0))
        self.children.append(None)
        self.leaf.append(-1)
        groups = _kmeans(points, random) if len(points) > LEAF and depth < 12 else []
        if len(groups) < 2:
            self.leaf[me] = self.n_leaves
            self.n_leaves += 1
        else:
            self.children[me] = np.array([self._grow(points[g], random, depth + 1) for g in groups])
        return me

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each vector descends to."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node] is None:
                out[rows] = self.leaf[node]
                continue
            below = self.children[node]
            c = self.centres[below]
            best = np.argmin((c * c).sum(1) - 2 * points[rows] @ c.T, axis=1)
            todo += [(int(child), rows[best == i]) for i, child in enumerate(below) if (best == i).any()]
        return out

    def visits(self, query: np.ndarray):
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.children[node] is None:
                yield self.leaf[node]
                continue
            below = self.children[node]
            gaps = ((self.centres[below] - query) ** 2).sum(axis=1)
            for gap, child in zip(gaps.tolist(), below.tolist()):
                heapq.heappush(queue, (gap, child))


def _kmeans(points: np.ndarray, random) -> list[np.ndarray]:
    """Row numbers of each non-empty cluster."""
    centres = np.unique(points[random.choice(len(points), min(BRANCHES, len(points)), replace=False)], axis=0)
    owner = np.zeros(len(points), np.int64)
    for _ in range(8):
        owner = np.argmin((centres * centres).sum(1) - 2 * points @ centres.T, axis=1)
        centres = np.array([points[owner == i].mean(axis=0) if (owner == i).any() else centres[i]
                            for i in range(len(centres))])
    return [np.flatnonzero(owner == i) for i in range(len(centres)) if (owner == i).any()]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _widened(points: np.ndarray, largest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0, largest - (points * points).sum(axis=1)))
    return np.hstack([points, rest[:, None]])


def best_of(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, visited=None):
    """Per query the k best of these vectors (visited: of those marked): row of query, row of vector, product."""
    rows, cols, values = [], [], []
    scores = queries @ vectors.T
    for i in range(len(queries)):
        other = ids != query_ids[i]
        own = np.flatnonzero(other if visited is None else other & visited[i])
        if len(own) > k:
            s = scores[i, own]
            edge = np.partition(s, len(s) - k)[len(s) - k]
            own = own[s >= edge - 1e-9 * (1 + abs(edge))]
        exact = (vectors[own] * queries[i]).sum(axis=1)  # summed in one order, so equal vectors tie
        order = np.lexsort((ids[own], -exact))[:k]
        rows.append(np.full(len(order), i))
        cols.append(own[order])
        values.append(exact[order])
    join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
    return join(rows, np.int64), join(cols, np.int64), join(values, np.float64)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    v = F.col("embedding")
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    found = sizes.collect()
    return rows.where(F.size("embedding") == (found[0]["d"] if found else 0))


def search(embeddings: DataFrame, queries: DataFrame, k: int = K, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: nearly the k largest inner products of each query.

    queries: vec_id and embedding, as returned by `usable`; so are embeddings.
    """
    spark = embeddings.sparkSession
    norms = embeddings.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d"), F.max(F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x * x)).alias("largest")).first()
    if not norms["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dims, largest = norms["d"], norms["largest"]
    block_rows = max(1, BLOCK_BYTES // (8 * dims))
    sample = max(1, min(sample, SAMPLE_BYTES // (8 * dims)))

    def few(frame: DataFrame, n: int, of: int) -> DataFrame:
        """The n rows of the smallest hashes, thinned out before they are sorted."""
        order = F.xxhash64("vec_id")
        if of > 2 * n:
            frame = frame.where(F.pmod(order, F.lit(1 << 20)) < max(1, (2 * n << 20) // of))
        return frame.orderBy(order, "vec_id").limit(n)

    fitted = few(embeddings, sample, norms["n"]).select("embedding").toArrow().column(0).combine_chunks()
    tree = spark.sparkContext.broadcast(Tree(_widened(_matrix(fitted), largest)))

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.assign(_widened(_matrix(batch.column(1)), largest))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "embedding", "leaf"])

    rows = write_table(embeddings.select("vec_id", "embedding").mapInArrow(
        assign, "vec_id bigint, embedding array<double>, leaf int"), "leaves")
    sizes = np.zeros(tree.value.n_leaves, np.int64)
    for r in rows.groupBy("leaf").count().collect():  # one row per leaf
        sizes[r["leaf"]] = r["count"]
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    n_asked = asked.count()
    visits = _calibrated(rows, few(queries, CALIBRATION, n_asked), tree, k)

    group = np.cumsum(sizes) // block_rows  # of each leaf

    def probe(batches):
        for batch in batches:
            at, groups, lists = [], [], []
            for i, q in enumerate(_matrix(batch.column(1)) if batch.num_rows else ()):
                reached, seen = 0, {}
                for n, leaf in enumerate(tree.value.visits(np.append(q, 0.0))):
                    if n >= visits and reached > k:
                        break
                    if sizes[leaf]:
                        seen.setdefault(int(group[leaf]), []).append(leaf)
                    reached += sizes[leaf]
                at += [i] * len(seen)
                groups += seen.keys()
                lists += seen.values()
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(groups, pa.int32()),
                 pa.array(lists, pa.list_(pa.int32()))], names=["query_id", "query", "grp", "leaves"])

    probes = write_table(asked.mapInArrow(
        probe, "query_id bigint, query array<double>, grp int, leaves array<int>"), "probes")
    held = np.bincount(group, weights=sizes)
    wanted = {r["grp"]: r["count"] for r in probes.groupBy("grp").count().collect()}  # one row per group
    blocks = F.broadcast(spark.createDataFrame(
        [(g, -(-int(held[g]) // block_rows), -(-n // BLOCK_QUERIES)) for g, n in wanted.items()],
        "grp int, row_blocks int, query_blocks int"))
    leaf_group = F.broadcast(spark.createDataFrame([(i, int(g)) for i, g in enumerate(group)], "leaf int, grp int"))
    number = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(leaf_group, "leaf").join(blocks, "grp").select(
        "grp", number("vec_id", "row_blocks").alias("r"), every("query_blocks").alias("q"), "vec_id", "embedding", "leaf")
    right = probes.join(blocks, "grp").select(
        "grp", every("row_blocks").alias("r"), number("query_id", "query_blocks").alias("q"), "query_id", "query", "leaves")

    def compare(vectors: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(asking):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        leaves, place = np.unique(vectors["leaf"].to_numpy(), return_inverse=True)
        marked = np.stack([np.isin(leaves, own) for own in asking["leaves"]])
        ids, query_ids = vectors["vec_id"].to_numpy(), asking["query_id"].to_numpy()
        points, asked_points, found = np.stack(vectors["embedding"]), np.stack(asking["query"]), []
        for at in range(0, len(query_ids), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            i, j, score = best_of(points, ids, asked_points[part], query_ids[part], k, marked[part][:, place])
            found.append(pd.DataFrame({"query_id": query_ids[part][i], "vec_id": ids[j], "score": score}))
        return pd.concat(found)

    near = left.groupBy("grp", "r", "q").cogroup(right.groupBy("grp", "r", "q")).applyInPandas(
        compare, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _calibrated(rows: DataFrame, queries: DataFrame, tree, k: int) -> int:
    """The fewest leaves that find RECALL of the true neighbours of these queries."""
    table = queries.toArrow()  # CALIBRATION rows at most
    ids = table.column("vec_id").to_numpy()
    if not len(ids):
        return 1
    asking = _matrix(table.column("embedding").combine_chunks())

    def exact(batches):
        found = None
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                names = part.column(0).to_numpy()
                i, j, score = best_of(_matrix(part.column(1)), names, asking, ids, k)
                new = pd.DataFrame({"query": i.astype(np.int32), "vec_id": names[j], "score": score,
                                    "leaf": part.column(2).to_numpy()[j]})
                found = new if found is None else pd.concat([found, new])
                found = found.sort_values(["query", "score", "vec_id"], ascending=[True, False, True])
                found = found.groupby("query").head(k)
        if found is not None:
            yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    best = rows.select("vec_id", "embedding", "leaf").mapInArrow(
        exact, "query int, vec_id bigint, score double, leaf int")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("query", "leaf").toPandas()
    needed = []
    for i, leaves in best.groupby("query")["leaf"]:
        place = {leaf: n + 1 for n, leaf in enumerate(tree.value.visits(np.append(asking[i], 0.0)))}
        needed += [place[leaf] for leaf in leaves]
    if not needed:
        return 1
    needed = np.sort(needed)
    return int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)])
