"""Largest inner products by vantage-point trees, one tree a shard.

Inner products become Euclidean distances by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, in which the
triangle inequality holds. A node keeps the range of distances from its vantage point to either half of its points; a half
is skipped if that range is further from a query than `factor` times the query's current k-th distance. Factor one is
exact search; smaller factors skip more. Queries go through a tree in blocks, near halves first; leaves are scored by one
matrix product each and what they return is scored anew in double precision, in one fixed order of addition.
"""

from __future__ import annotations

import io
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
LEAF = 512
BLOCK = 1024


def build(points, leaf: int = LEAF):
    """(order, nodes): points in leaf order, and rows (start, stop, vantage, left, right) with distance ranges a child."""
    import numpy as np

    order, nodes, ranges = np.arange(len(points)), [], []

    def grow(start: int, stop: int) -> int:
        at = len(nodes)
        nodes.append([start, stop, -1, -1, -1])
        ranges.append([0.0] * 4)
        if stop - start > leaf:
            own = order[start:stop]
            far = np.linalg.norm(points[own] - points[own[0]], axis=1).argmax()
            vantage = own[far]
            d = np.linalg.norm(points[own] - points[vantage], axis=1)
            half = (stop - start) // 2
            by = np.argpartition(d, half)  # halves by rank: equal distances may fall on both sides
            order[start:stop], d = own[by], d[by]
            spans = [d[:half].min(), d[:half].max(), d[half:].min(), d[half:].max()]
            left, right = grow(start, start + half), grow(start + half, stop)
            nodes[at][2:], ranges[at] = [int(vantage), left, right], [float(x) for x in spans]
        return at

    if len(points):
        grow(0, len(points))
    return order, np.array(nodes, np.int64).reshape(-1, 5), np.array(ranges).reshape(-1, 4)


def search(vectors, ids, tree, m2: float, queries, query_ids, k: int, factor: float):
    """(query number, id, score, leaves visited): the k nearest found of each query, itself left out."""
    import numpy as np

    order, nodes, ranges = tree
    x, own = vectors[order], ids[order]
    points = np.hstack([vectors, np.sqrt(np.maximum(m2 - (vectors**2).sum(axis=1), 0))[:, None]])
    best = np.full((len(queries), k), -np.inf)
    place = np.full((len(queries), k), -1)
    norm2, visited = (queries**2).sum(axis=1), 0

    def scan(start: int, stop: int, rows) -> None:
        nonlocal visited
        visited += len(rows)
        s = queries[rows] @ x[start:stop].T
        s[query_ids[rows][:, None] == own[start:stop][None, :]] = -np.inf
        # ties go to the smaller id: what the product rounds apart by less than this is compared by fixed-order sums
        slack = 1e-12 * (1 + np.sqrt(m2 * norm2[rows]))
        joined = np.hstack([best[rows], s])
        kth = -np.partition(-joined, k - 1, axis=1)[:, k - 1]
        for i, row in zip(np.flatnonzero((s >= (kth - slack)[:, None]).any(axis=1)), rows[(s >= (kth - slack)[:, None]).any(axis=1)]):
            at = np.flatnonzero((s[i] >= kth[i] - slack[i]) & (s[i] > -np.inf))
            exact = (x[start + at] * queries[row]).sum(axis=1)
            all_s, all_p = np.concatenate([best[row], exact]), np.concatenate([place[row], start + at])
            ids_ = np.where(all_p >= 0, own[all_p], np.iinfo(np.int64).max)
            top = np.lexsort((ids_, -all_s))[:k]
            best[row], place[row] = all_s[top], all_p[top]

    def visit(node: int, rows) -> None:
        start, stop, vantage, left, right = nodes[node]
        if vantage < 0:
            scan(start, stop, rows)
            return
        d = np.sqrt(np.maximum(((queries[rows] - points[vantage, :-1]) ** 2).sum(axis=1) + points[vantage, -1] ** 2, 0))
        a, b, c, e = ranges[node]
        gap = np.stack([np.maximum(np.maximum(a - d, d - b), 0), np.maximum(np.maximum(c - d, d - e), 0)])
        near = np.where(gap[0] == gap[1], np.where(np.abs(d - (a + b) / 2) <= np.abs(d - (c + e) / 2), 0, 1), gap.argmin(axis=0))
        for turn in (0, 1):
            for side, child in ((0, left), (1, right)):
                here = np.flatnonzero(near == (side if turn == 0 else 1 - side))
                if turn and len(here):
                    tau = np.sqrt(np.maximum(norm2[rows[here]] + m2 - 2 * best[rows[here], -1], 0))
                    here = here[gap[side][here] <= factor * tau + 1e-9 * (1 + math.sqrt(m2))]
                if len(here):
                    visit(child, rows[here])

    if len(nodes):
        visit(0, np.arange(len(queries)))
    q, j = np.nonzero(place >= 0)
    return q, own[place[q, j]], best[q, j], visited


def _pack(**arrays) -> bytes:
    import numpy as np

    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>, norm2) of rows with an id and a finite, non-zero vector of the most frequent dimension."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL").filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)).filter("norm2 > 0")
    dim = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").select("dim").first()
    return rows.filter(F.size("v") == (dim[0] if dim else 0))


def nearest(vectors: DataFrame, query_filter, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, factor: float = 1.0, shard_rows: int = SHARD_ROWS, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, <id_col>, score): the k largest inner products found for each row that query_filter keeps.

    Every row of another id is a candidate; rows that repeat both id and vector count once. Null, zero and non-finite vectors, null ids and vectors of another than the most frequent dimension take no part.
    """
    import pyarrow as pa

    rows = usable(vectors, id_col, vec_col)
    n, m2 = rows.agg(F.count("*"), F.max("norm2")).first()
    shards = max(1, math.ceil(n / shard_rows))
    m2 = float(m2 or 0.0)

    def arrays(batch):
        import numpy as np

        flat = batch.column("v").combine_chunks().flatten() if isinstance(batch.column("v"), pa.ChunkedArray) else batch.column("v").flatten()
        ids = batch.column("id").to_numpy()
        return ids, np.asarray(flat).reshape(len(ids), -1)

    def index(table):
        import numpy as np

        ids, v = arrays(table)
        by = np.argsort(ids, kind="stable")
        ids, v = ids[by], v[by]
        order, nodes, spans = build(np.hstack([v, np.sqrt(np.maximum(m2 - (v**2).sum(axis=1), 0))[:, None]]), leaf)
        data = _pack(ids=ids, v=v, order=order, nodes=nodes, spans=spans)
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "block": pa.array([-1], pa.int64()), "data": pa.array([data], pa.binary())})

    trees = rows.select("id", "v").dropDuplicates().select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard")).groupBy("shard").applyInArrow(index, "shard int, block long, data binary")

    def blocks(parts):
        from pyspark import TaskContext

        pid, made = TaskContext.get().partitionId(), 0
        for batch in parts:
            for at in range(0, len(batch), block):
                ids, v = arrays(batch.slice(at, block))
                yield pa.RecordBatch.from_arrays([pa.array([(pid << 32) + made], pa.int64()), pa.array([_pack(ids=ids, v=v)], pa.binary())], names=["block", "data"])
                made += 1

    asked = rows.filter(query_filter).select("id", "v").dropDuplicates().coalesce(max(1, shards // 4)).mapInArrow(blocks, "block long, data binary")
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "data")

    def run(parts):
        import numpy as np

        tree = None
        for batch in parts:
            for shard, number, data in zip(batch.column("shard"), batch.column("block"), batch.column("data")):
                got = np.load(io.BytesIO(data.as_py()))
                if number.as_py() < 0:
                    tree = (shard.as_py(), *(got[name] for name in ("ids", "v", "order", "nodes", "spans")))
                elif tree and tree[0] == shard.as_py():
                    _, ids, v, order, nodes, spans = tree
                    q, found, score, _ = search(v, ids, (order, nodes, spans), m2, got["v"], got["ids"], k, factor)
                    yield pa.RecordBatch.from_arrays([pa.array(got["ids"][q]), pa.array(found), pa.array(score)], names=["query_id", "id", "score"])

    parts = trees.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "block")
    found = parts.mapInArrow(run, "query_id long, id long, score double").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
