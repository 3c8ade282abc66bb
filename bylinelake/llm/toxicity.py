"""Toxicity by maximum-scoring segments over token log-odds.

Token log-odds come from labelled rows with an informative Dirichlet prior (background counts); tokens without a
significant difference share one pooled, slightly negative score. A linear-time scan finds every maximal-scoring segment
of a text. Segment scores are put on the extreme-value scale, lambda * S - ln(K * N) with lambda and K of the clean rows,
the significant ones are added up, and a logistic curve over that sum gives the document score.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, lean

BUCKET_BITS = 18
#: The model is fitted on at most this many labelled rows, those of least xxhash64(id).
TRAIN_ROWS = 20_000


@functools.lru_cache(maxsize=1)
def _token_bytes():
    import numpy as np

    out = np.zeros(256, bool)
    out[128:] = True
    for b in b"abcdefghijklmnopqrstuvwxyz0123456789'":
        out[b] = True
    return out


def tokens(texts: list[str], bucket_bits: int = BUCKET_BITS):
    """(bucket of each token, row pointers): tokens are runs of letters, digits, apostrophes and bytes over 127, lower-cased."""
    import numpy as np

    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    edge = np.cumsum([0] + [len(r) + 1 for r in raw])
    on = _token_bytes()[data]
    step = np.diff(np.concatenate([[False], on, [False]]).astype(np.int8))
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    sizes = stops - starts
    place = np.flatnonzero(on) - np.repeat(starts, sizes)
    power = np.full(int(sizes.max()), 0x100000001B3, np.uint64)
    power[0] = 1
    value = (data[on].astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(power)[place]
    h = np.add.reduceat(value, np.concatenate([[0], np.cumsum(sizes)[:-1]])) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - bucket_bits)).astype(np.int64), np.searchsorted(starts, edge)


def segments(scores) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, stop, score) of a score sequence, in linear time over its positive places."""
    import numpy as np

    total = np.concatenate([[0.0], np.cumsum(scores)])
    out: list[list] = []  # start, stop, sum before, sum after
    below: list[int] = []  # of each candidate, the nearest earlier one with a smaller sum before, or -1
    for k in np.flatnonzero(scores > 0).tolist():
        now = [k, k + 1, float(total[k]), float(total[k + 1])]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= now[2]:
                j = below[j]
            if j < 0 or out[j][3] >= now[3]:
                out.append(now)
                below.append(j)
                break
            now = [out[j][0], now[1], out[j][2], now[3]]
            del out[j:], below[j:]
    return [(a, b, r - l) for a, b, l, r in out]


def statistic(scores, lam: float, k: float) -> tuple[float, list[tuple[int, int, float]]]:
    """The doc's sum on the extreme-value scale, and its significant segments. At least the best segment counts."""
    import math

    if not len(scores):
        return -math.log(k) if k > 0 else 0.0, []
    found = sorted(((lam * s - math.log(k * len(scores)), a, b, s) for a, b, s in segments(scores)), reverse=True)
    if not found:
        return -math.log(k * len(scores)), []
    good = [x for x in found if x[0] > 0]
    return (sum(x[0] for x in good) if good else found[0][0]), sorted((a, b, s) for _, a, b, s in good)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bucket_bits: int = BUCKET_BITS, train_rows: int = TRAIN_ROWS, prior: float = 0.01, floor: float = 0.25, z: float = 2.6) -> dict:
    """Token scores, lambda, K and the logistic curve, from rows of labels that are usable and have a label and a text.

    A document with several labels counts for each, and so does a repeated one. Without rows of both classes every score is
    0.5. Labels are counted by rows, so train_rows bounds what is broadcast and what comes to the driver (three numbers a row).
    """
    import numpy as np
    import pyarrow as pa

    picked = labels.filter(usable & F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"), F.xxhash64(F.col(id_col).cast("string")).alias("h")).orderBy("h", "id", "y").limit(train_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL").join(F.broadcast(picked), "id").select("y", "text")
    size = 1 << bucket_bits

    def count(parts):
        n = np.zeros((2, size), np.int64)
        for batch in parts:
            for start, stop in batches(batch.column("text")):
                b, ptr = tokens(batch.column("text").slice(start, stop - start).to_pylist(), bucket_bits)
                y = np.repeat(batch.column("y").slice(start, stop - start).to_numpy() > 0, np.diff(ptr)).astype(np.int64)
                n += np.bincount(y * size + b, minlength=2 * size).reshape(2, size)
        for c in (0, 1):
            at = np.flatnonzero(n[c])
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(at), pa.int32()), pa.array(at), pa.array(n[c][at])], names=["y", "bucket", "n"])

    sums = rows.mapInArrow(lean(count), "y int, bucket long, n long").groupBy("y", "bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros((2, size))
    n[sums["y"].to_numpy(dtype=int), sums["bucket"].to_numpy(dtype=int)] = sums["n"].to_numpy()
    model = {"scores": np.zeros(size), "lam": 1.0, "k": 1.0, "a": 0.0, "b": 0.0, "bits": bucket_bits}
    if not n[0].sum() or not n[1].sum():
        return model
    alpha = prior * n.sum(axis=0) + floor
    odds = [np.log((n[c] + alpha) / ((n[c] + alpha).sum() - n[c] - alpha)) for c in (0, 1)]
    delta = odds[1] - odds[0]
    strong = np.abs(delta) / np.sqrt(1 / (n[0] + alpha) + 1 / (n[1] + alpha)) >= z
    weak = [n[c][~strong].sum() / n[c].sum() for c in (0, 1)]
    scores = np.where(strong, delta, min(-1e-3, np.log(weak[1] / weak[0])) if weak[0] and weak[1] else -1e-3)
    clean, lo, hi = n[0] / n[0].sum(), 1e-3, 50.0
    for _ in range(60):  # lambda: the positive root of E[exp(lambda s)] = 1 over clean tokens
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (clean * np.exp(np.minimum(mid * scores, 500))).sum() < 1 else (lo, mid)
    model |= {"scores": scores, "lam": lo}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(kind: str, of):
        """(y, value, n) a training row: one short row each, whatever the length of its text."""

        def run(parts):
            m = shared.value
            for batch in parts:
                for start, stop in batches(batch.column("text")):
                    b, ptr = tokens(batch.column("text").slice(start, stop - start).to_pylist(), bucket_bits)
                    own = [m["scores"][b[ptr[i] : ptr[i + 1]]] for i in range(len(ptr) - 1)]
                    yield pa.RecordBatch.from_arrays([batch.column("y").slice(start, stop - start), pa.array([of(x) for x in own], pa.float64()), pa.array([len(x) for x in own], pa.int64())], names=["y", kind, "n"])

        return rows.mapInArrow(lean(run), f"y int, {kind} double, n long").toPandas()

    seen = each("top", lambda x: max((s for _, _, s in segments(x)), default=0.0))
    null = seen[(seen["y"] == 0) & (seen["top"] > 0) & (seen["n"] > 0)]
    if len(null):
        model["k"] = float(np.log(2) / np.median(null["n"] * np.exp(-model["lam"] * null["top"])))
        model["k"] = min(max(model["k"], 1e-6), 1e3)
    lam, k = model["lam"], model["k"]
    seen = each("x", lambda x: statistic(x, lam, k)[0])
    x = seen["x"].to_numpy()
    x, y, w = np.clip(x, -30, 30), (seen["y"].to_numpy() > 0).astype(float), np.zeros(2)
    f = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-f @ w))
        step = np.linalg.solve((f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(2), f.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return model | {"a": float(w[0]), "b": max(0.0, float(w[1]))}


def _scored(texts: list[str | None], model: dict):
    """(scores, significant segments) of texts."""
    import numpy as np

    b, ptr = tokens([t or "" for t in texts], model["bits"])
    got = [statistic(model["scores"][b[ptr[i] : ptr[i + 1]]], model["lam"], model["k"]) for i in range(len(texts))]
    x = np.clip([t for t, _ in got], -30, 30)
    return 1 / (1 + np.exp(-(model["a"] + model["b"] * x))), [found for _, found in got]


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, passages) a row; passages: array<struct<start, stop, score>> of significant segments by token number.

    A null or empty text has no passage and the score of an empty statistic. Repeated rows stay; other columns are left out.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        m = shared.value
        for batch in parts:
            for start, stop in batches(batch.column("text")):
                p, found = _scored(batch.column("text").slice(start, stop - start).to_pylist(), m)
                spans = [[{"start": a, "stop": b, "score": s} for a, b, s in x] for x in found]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(start, stop - start), pa.array(p, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())])))], names=["id", "score", "passages"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(lean(run), f"id {kind}, score double, passages array<struct<start:int,stop:int,score:double>>").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs without the rows that score threshold or more. All columns stay."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        for batch in parts:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for start, stop in batches(texts):
                p, _ = _scored(texts.slice(start, stop - start).to_pylist(), shared.value)
                yield batch.slice(start, stop - start).filter(pa.array(p < threshold))

    return docs.mapInArrow(lean(run), docs.schema)
