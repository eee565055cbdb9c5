"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ruleframe.session import stage


@dataclass(frozen=True)
class Tree:
    """Centres of all nodes; the children of node i are first[i] .. first[i] + count[i] - 1, and node i is
    leaf number leaf[i] if it has none."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre, level by level."""
        node = np.zeros(len(vectors), np.int64)
        while True:
            inner = np.flatnonzero(self.count[node] > 0)
            if not len(inner):
                return self.leaf[node]
            for parent in np.unique(node[inner]):
                rows = inner[node[inner] == parent]
                first = self.first[parent]
                children = self.centres[first : first + self.count[parent]]
                node[rows] = first + _squares(vectors[rows], children).argmin(axis=1)

    def best_bins(self, vector: np.ndarray, visits: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``visits`` leaves of a best-bin-first traversal: the open node whose centre is nearest
        comes next, whatever branch it is on. With the ``sizes`` of the leaves it goes on until those
        found hold ``least`` members."""
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < visits or (sizes is not None and held < least)):
            _, node = heapq.heappop(queue)
            if not self.count[node]:
                found.append(int(self.leaf[node]))
                held += 0 if sizes is None else int(sizes[found[-1]])
                continue
            first = int(self.first[node])
            distances = _squares(vector[None], self.centres[first : first + self.count[node]])[0]
            for i, d in enumerate(distances.tolist()):
                heapq.heappush(queue, (d, first + i))
        return found


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None]


def fit_tree(sample: np.ndarray, branch: int = 16, leaf_size: int = 256, seed: int = 5) -> Tree:
    """Split the sample by k-means into ``branch`` parts, and each part again, down to ``leaf_size``."""
    random = np.random.default_rng(seed)
    centres, first, count, leaf = [sample.mean(axis=0)], [0], [0], [-1]
    todo, leaves = [(0, sample)], 0
    while todo:
        node, rows = todo.pop()
        parts = _kmeans(rows, branch, random) if len(rows) > leaf_size else None
        if parts is None:
            leaf[node] = leaves
            leaves += 1
            continue
        means, label = parts
        first[node], count[node] = len(centres), len(means)
        for i, mean in enumerate(means):
            todo.append((len(centres), rows[label == i]))
            centres.append(mean)
            first.append(0)
            count.append(0)
            leaf.append(-1)
    return Tree(np.array(centres), np.array(first), np.array(count), np.array(leaf))


def _kmeans(rows: np.ndarray, parts: int, random: np.random.Generator, rounds: int = 12):
    """Centres and labels, or None if the rows cannot be split."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) < 2:
        return None
    means = distinct[random.choice(len(distinct), min(parts, len(distinct)), replace=False)]
    for _ in range(rounds):
        label = _squares(rows, means).argmin(axis=1)
        used = np.unique(label)
        means = np.stack([rows[label == i].mean(axis=0) for i in used])
    label = _squares(rows, means).argmin(axis=1)
    used, label = np.unique(label, return_inverse=True)
    return (means[used], label) if len(used) > 1 else None


def usable_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): rows with an id and a vector of the most frequent length whose components are all finite and
    not all zero; equal rows once."""
    values = F.col("v")
    good = values.isNotNull() & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & good & F.exists(values, lambda x: x != 0)).withColumn("size", F.size("v"))
    size = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).select("size")
    return rows.join(F.broadcast(size), "size", "left_semi").select("id", "v").distinct()  # one row


def _arrays(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(
    vectors: DataFrame, queries: DataFrame, *, k: int = 10, recall: float = 0.95, sample: int = 32_768,
    leaf_size: int = 256, branch: int = 16, trials: int = 256, tile: int = 4096,
) -> DataFrame:
    """(query, rank, id, distance): the ``k`` nearest of ``vectors`` for each of ``queries``, both (id, v)
    as ``usable_vectors`` gives them; a row with the query's id is the query itself.

    The tree is fitted on at most ``sample`` vectors, those with the smallest hash of their id; every
    vector is then put into its leaf. For ``trials`` queries (again by hash) the exact neighbours are
    found against all vectors, and the number of leaves to visit is widened until ``recall`` of them are
    met; if the leaves do not give it, all are visited. A query whose leaves hold fewer than ``k`` others
    visits more, so that every query gets ``k`` if there are as many. Distances are Euclidean, in double precision on
    the vectors given; ties go to the smaller id. Fewer than ``k`` candidates give them all; no queries or
    no vectors give no rows. Vectors that are equal are kept with their k + 1 smallest ids only, since
    no answer can hold more of them. A leaf is searched in tiles of at most about ``tile`` members by
    ``tile`` queries, so that no leaf, however full, is one task's.
    """
    spark = vectors.sparkSession
    same = Window.partitionBy("v").orderBy("id")
    kept = vectors.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n")
    kept = stage(kept, "vectors")
    fitted = kept.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()["v"].combine_chunks()
    empty = spark.createDataFrame([], f"query {queries.schema['id'].dataType.simpleString()}, rank int, id {vectors.schema['id'].dataType.simpleString()}, distance double")
    if not len(fitted):
        return empty
    dim = len(fitted[0])
    tree = fit_tree(_arrays(fitted, dim), branch, leaf_size)
    shared = spark.sparkContext.broadcast(tree)
    asked = stage(queries, "queries")
    visits = _calibrate(kept, asked, tree, shared, dim, k, recall, trials)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(_arrays(batch.column(1), dim)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], ["id", "v", "leaf"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shared.value.best_bins(v, visits, sizes.value, k + 1) for v in _arrays(batch.column(1), dim)] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int64()))], ["id", "v", "leaves"])

    kind, asked_kind = (d.schema["id"].dataType.simpleString() for d in (kept, asked))
    members = stage(kept.select("id", "v").mapInArrow(place, f"id {kind}, v array<double>, leaf long"), "leaves")
    filled = members.groupBy("leaf").count().collect()  # at most one row for each leaf of the tree
    sizes = np.zeros(tree.leaves, np.int64)
    sizes[[r["leaf"] for r in filled]] = [r["count"] for r in filled]
    sizes = spark.sparkContext.broadcast(sizes)
    seeking = asked.select("id", "v").mapInArrow(visit, f"id {asked_kind}, v array<double>, leaves array<long>")
    seeking = stage(seeking.select("id", "v", F.explode("leaves").alias("leaf")), "visits")
    # How many tiles a leaf needs on either side; two small tables of one row per leaf.
    parts = members.groupBy("leaf").agg(F.ceil(F.count("*") / tile).alias("rows"))
    asks = seeking.groupBy("leaf").agg(F.ceil(F.count("*") / tile).alias("columns"))
    grid = stage(parts.join(asks, "leaf"), "tiles")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return rows.join(grid, "leaf").select(
            "leaf", F.pmod(F.xxhash64("id"), F.col(own)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other), "id", "v",
        )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        a, b = (_arrays(t["v"].combine_chunks(), dim) for t in (left, right))
        ids, names = right["id"].to_numpy(), left["id"].to_numpy()
        squares = _squares(a, b)  # fast but rounded: exact distances only where they may count
        squares[names[:, None] == ids[None]] = np.inf
        last = np.partition(squares, min(k, len(b)) - 1, axis=1)[:, min(k, len(b)) - 1]
        slack = 1e-9 * ((a * a).sum(axis=1) + (b * b).sum(axis=1).max())
        found = []
        for i, reach in enumerate(last + slack):
            near = np.flatnonzero((squares[i] <= reach) & (ids != names[i]))
            distances = np.sqrt(((b[near] - a[i]) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], distances))[:k]
            found += [(names[i], j, d) for j, d in zip(ids[near[best]], distances[best])]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, out.types)], out.names)

    out = pa.schema([("query", asked.limit(0).toArrow().schema.field("id").type), ("id", kept.limit(0).toArrow().schema.field("id").type), ("distance", pa.float64())])
    key = ["leaf", "rows", "columns"]
    pairs = (
        dealt(seeking, "columns", "rows").groupBy(*key)
        .cogroup(dealt(members, "rows", "columns").groupBy(*key))
        .applyInArrow(compare, f"query {asked_kind}, id {kind}, distance double")
    )
    order = Window.partitionBy("query").orderBy("distance", "id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "id", "distance")


def _calibrate(kept: DataFrame, asked: DataFrame, tree: Tree, shared, dim: int, k: int, recall: float, trials: int) -> int:
    """How many leaves must be visited to meet ``recall`` of the exact neighbours of ``trials`` queries."""
    table = asked.orderBy(F.xxhash64("id"), "id").limit(trials).select("id", "v").toArrow()
    if not table.num_rows:
        return 1
    names, points = table["id"].to_numpy(), _arrays(table["v"].combine_chunks(), dim)
    probe = kept.sparkSession.sparkContext.broadcast((names, points))

    def nearest_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, points = probe.value
        best_d, best_leaf = np.full((len(points), k), np.inf), np.zeros((len(points), k), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                rows = _arrays(batch.column(1), dim)
                leaf = shared.value.assign(rows)
                d = _squares(points, rows)
                d[names[:, None] == batch.column(0).to_numpy()[None]] = np.inf
                d = np.concatenate([best_d, d], axis=1)
                leaf = np.concatenate([best_leaf, np.broadcast_to(leaf, (len(points), len(leaf)))], axis=1)
                best = np.argpartition(d, k - 1, axis=1)[:, :k]
                best_d, best_leaf = np.take_along_axis(d, best, 1), np.take_along_axis(leaf, best, 1)
        seen = np.isfinite(best_d)
        probe_of = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(probe_of), pa.array(best_d[seen]), pa.array(best_leaf[seen])], ["probe", "d", "leaf"])

    near = kept.select("id", "v").mapInArrow(nearest_here, "probe long, d double, leaf long")
    order = Window.partitionBy("probe").orderBy("d")
    rows = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("probe", "leaf").collect()  # trials * k
    place = [{leaf: i for i, leaf in enumerate(tree.best_bins(p, tree.leaves))} for p in points]
    needed = np.sort([place[r.probe][r.leaf] + 1 for r in rows])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if len(needed) else 1
