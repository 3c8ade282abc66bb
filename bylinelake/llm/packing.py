"""Packing token sequences into windows: non-negative least squares over shallow length combinations.

Documents are encoded and cut into whole windows and one tail each. Tail lengths are rounded up to bins; all combinations
of at most `depth` bins that fill a window exactly are enumerated, and their repeat counts are solved against the
histogram by non-negative least squares, rounded down and checked against the stock of each bin. Tails that no
combination takes are packed greedily, one after another, cut where a window is full, so that only the very last window
of them is padded. All state on the driver is by bin (window / resolution of them), never by document.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import batches, lean, written

#: A cut list of at most this many rows is broadcast; a longer one is joined by shuffling.
BROADCAST_ROWS = 100_000


def combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All non-increasing tuples of at most depth bin numbers (1..bins-1) that sum to bins."""
    out: list[tuple[int, ...]] = []

    def grow(left: int, most: int, got: tuple[int, ...]) -> None:
        if len(got) == depth - 1:
            if 0 < left <= most:
                out.append((*got, left))
            return
        for b in range(min(left, most), 0, -1):
            if b == left:
                out.append((*got, b))
            elif b * (depth - len(got)) >= left:
                grow(left - b, b, (*got, b))

    grow(bins, bins - 1, ())
    return out


def nnls(columns, target, steps: int = 0):
    """Lawson-Hanson active set: x >= 0 with the least |A x - target|; column j of A counts the bins in columns[j]."""
    import numpy as np

    n, m = len(columns), len(target)
    A = np.zeros((m, n))
    for j, c in enumerate(columns):
        for b in c:
            A[b, j] += 1
    target = np.asarray(target, float)
    scale = target.max() or 1.0
    y, x, passive = target / scale, np.zeros(n), np.zeros(n, bool)
    for _ in range(steps or 3 * m):
        w = A.T @ (y - A @ x)
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if not w[j] > 1e-9:
            break
        passive[j] = True
        while True:
            at = np.flatnonzero(passive)
            own = A[:, at]
            try:
                z = np.linalg.solve(own.T @ own, own.T @ y)
            except np.linalg.LinAlgError:
                z = np.linalg.lstsq(own, y, rcond=None)[0]
            if (z > 1e-12).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 1e-12
            ratio = x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)
            a = min(1.0, float(ratio.min()))
            x[at] += a * (z - x[at])
            drop = at[(x[at] <= 1e-12)]
            x[drop] = 0
            passive[drop] = False
            if not passive.any():
                break
    return x * scale


def plan(histogram: dict[int, int], bins: int, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (bins in a window) and their repeat counts; never more of a bin than the histogram has."""
    import numpy as np

    out = [((bins,), histogram[bins])] if histogram.get(bins) else []
    stock = np.array([histogram.get(b, 0) if b < bins else 0 for b in range(bins)], np.int64)
    usable = [c for c in combinations(bins, depth) if all(stock[b] for b in c)]
    if usable:
        x = nnls(usable, stock)
        for j in np.argsort(-x, kind="stable"):
            need = np.bincount(usable[j], minlength=bins)
            at = np.flatnonzero(need)
            n = min(int(np.floor(x[j] + 1e-6)), int((stock[at] // need[at]).min()))
            if n > 0:
                stock -= n * need
                out.append((usable[j], n))
    return out


def _cut_documents(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, window: int, resolution: int, keep_full: bool) -> DataFrame:
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts):
        import numpy as np
        from pyspark import TaskContext

        enc, pid, seen = encoder(tokenizer), TaskContext.get().partitionId(), [0] * (window // resolution + 2)
        tail = np.array([end_id], enc.dtype)
        for batch in parts:
            for start, stop in batches(batch.column("text"), 1 << 21):
                names, rows = batch.column("id").slice(start, stop - start).to_pylist(), []
                for doc, text in zip(names, batch.column("text").slice(start, stop - start)):
                    ids = np.concatenate([enc.encode(text.as_py() or ""), tail])
                    for at in range(0, len(ids), window):
                        piece = ids[at : at + window]
                        b = -(-len(piece) // resolution)
                        keep = keep_full or len(piece) < window
                        rows.append((doc, at, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), len(ids), pid, b, seen[b], piece.astype("<u4").tobytes() if keep and keep_full else piece.tobytes() if keep else None))
                        seen[b] += 1
                cols = list(zip(*rows)) or [[]] * 9
                kinds = (batch.schema.field("id").type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "start", "length", "crc", "doc_tokens", "pid", "bin", "rank", "ids"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(lean(run), f"id {kind}, start long, length long, crc long, doc_tokens long, pid int, bin int, rank long, ids binary")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1, resolution: int = 8, depth: int = 3, with_ids: bool = False) -> DataFrame:
    """One row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (u32 LE) if with_ids.

    Every id of a document and its end_id lies in exactly one piece. A null text is empty (one id). Repeated rows are
    packed each for itself; a null id stays null; an empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    if window % resolution:
        raise ValueError("window must be a multiple of resolution")
    bins = window // resolution
    pieces = written(_cut_documents(docs, id_col, text_col, tokenizer, end_id, window, resolution, with_ids), "pieces")
    wide = with_ids or encoder(tokenizer).dtype.itemsize == 4
    patterns = plan({r["bin"]: r["count"] for r in pieces.groupBy("bin").count().collect()}, bins, depth)

    slots, taken, base = [], [0] * (bins + 1), 0
    for pattern, n in patterns:
        for k, b in enumerate(pattern):
            slots.append((b, taken[b], taken[b] + n, base, k))
            taken[b] += n
        base += n
    # at most one row for each slot of each pattern, and a least-squares solution has no more patterns than bins
    slot_df = spark.createDataFrame(slots, "bin int, lo long, hi long, first long, slot int")
    before = Window.partitionBy("bin").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.groupBy("pid", "bin").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = pieces.drop("ids").join(offsets, ["pid", "bin"]).withColumn("g", F.col("base") + F.col("rank"))
    s = F.broadcast(slot_df).alias("s")
    placed = ranked.alias("r").join(s, (F.col("r.bin") == F.col("s.bin")) & (F.col("g") >= F.col("lo")) & (F.col("g") < F.col("hi")), "left")
    placed = written(placed.select("r.id", "start", "length", "crc", "doc_tokens", "pid", "r.bin", "rank", (F.col("first") + F.col("g") - F.col("lo")).alias("sequence_id"), "slot"), "placed")

    so_far = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    fitted = placed.filter("sequence_id IS NOT NULL").withColumn("offset", F.coalesce(F.sum("length").over(so_far), F.lit(0)))

    rest = placed.filter("sequence_id IS NULL").drop("sequence_id", "slot")
    by_pid = rest.groupBy("pid").agg(F.sum("length").alias("n"))
    by_pid = by_pid.withColumn("first", F.coalesce(F.sum("n").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = Window.partitionBy("pid").orderBy("bin", "rank").rowsBetween(Window.unboundedPreceding, -1)
    at = rest.join(by_pid, "pid").withColumn("at", F.col("first") + F.coalesce(F.sum("length").over(within), F.lit(0)))
    one = F.least("length", F.lit(window) - F.col("at") % window)
    part = lambda skip, n: F.struct(skip.cast("long").alias("skip"), n.alias("n"))
    parts = at.withColumn("one", one).withColumn("p", F.explode(F.filter(F.array(part(F.lit(0), F.col("one")), part(F.col("one"), F.col("length") - F.col("one"))), lambda x: x["n"] > 0)))
    parts = written(parts.select("id", (F.col("start") + F.col("p.skip")).alias("start"), F.col("p.n").alias("length"), F.when(F.col("p.n") == F.col("length"), F.col("crc")).alias("crc"), "doc_tokens", "pid", "bin", "rank", F.col("p.skip").alias("skip"), (F.lit(base) + F.floor((F.col("at") + F.col("p.skip")) / window)).alias("sequence_id"), ((F.col("at") + F.col("p.skip")) % window).alias("offset")), "parts")

    @F.pandas_udf("binary")
    def cut(ids, skip, n):
        import numpy as np
        import pandas as pd

        kind = "<u4" if wide else "<u2"
        return pd.Series([np.frombuffer(x, kind)[k : k + m].astype("<u4").tobytes() for x, k, m in zip(ids, skip, n)], dtype=object)

    key = ["pid", "bin", "rank"]
    need = parts if with_ids else parts.filter("crc IS NULL")
    need = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    cuts = pieces.select(*key, "ids").join(need, key).withColumn("ids", cut("ids", "skip", "length")).withColumn("crc", F.crc32("ids"))
    cols = ["id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        out = fitted.join(pieces.select(*key, "ids"), key).select(*cols, "ids").unionByName(cuts.select(*cols, "ids"))
    else:
        out = fitted.select(cols).unionByName(parts.filter("crc IS NOT NULL").select(cols)).unionByName(cuts.select(cols))
    return out.withColumnsRenamed({"id": id_col, "crc": "ids_crc32"})
