"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams by language in fixed-size numpy arrays a task and sums them in Spark; the log-probability matrix
(languages x buckets, bounded by both parameters) is broadcast. Scoring keeps a batch's n-grams as one sparse row-pointer
and bucket array, gathers the matrix by bucket and sums by document. Non-letters act as blanks.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, lean

BUCKET_BITS = 16
ORDERS = (1, 2, 3)
#: The classifier is fitted on at most this many labelled rows, those of least xxhash64(id).
TRAIN_ROWS = 20_000
UNDETERMINED = "und"


@functools.lru_cache(maxsize=1)
def _letters():
    import numpy as np

    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(texts: list[str], orders=ORDERS, bucket_bits: int = BUCKET_BITS):
    """(buckets by order, starts, letters): bucket numbers a position, row pointers, and letters a text.

    Position i of a text stands for the n-grams that begin there, one blank before the text included; those that begin with two
    blanks (or are one) get the dummy bucket. What a text gets does not depend on the others.
    """
    import numpy as np

    lowered, gap = [t.lower() for t in texts], max(orders)
    blank = "\n" * gap  # so wide that no n-gram reaches another text; its last place begins the next text
    cps = np.frombuffer((blank + "".join(t + blank for t in lowered)).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    starts = gap - 1 + np.cumsum(sizes + gap) - (sizes + gap)
    letter = _letters()[cps]
    c = np.where(letter, cps, 32).astype(np.uint64)
    pad = np.concatenate([c, np.full(gap, 32, np.uint64)])
    near = np.concatenate([letter, np.zeros(gap, bool)])
    dummy, out = 1 << bucket_bits, []
    for n in orders:
        h, real = np.zeros(len(c), np.uint64), np.zeros(len(c), bool)
        for k in range(n):
            h = (h + pad[k : k + len(c)] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            real |= near[k : k + len(c)] if k < 2 else False
        out.append(np.where(real, (h >> np.uint64(64 - bucket_bits)).astype(np.int64), dummy))
    return out, starts, np.add.reduceat(letter.astype(np.int64), starts)


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", orders=ORDERS, bucket_bits: int = BUCKET_BITS, train_rows: int = TRAIN_ROWS, smoothing: float = 0.5) -> tuple[list[str], object]:
    """(languages in order, log probabilities (languages, buckets + 1)) from rows that are usable and have a language.

    Class priors are even. Without any labelled row there are no languages. Rows that repeat an id at the edge of the sample are
    all taken. The driver holds a row of buckets for each language among them.
    """
    import numpy as np
    import pyarrow as pa

    rows = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string")).alias("h"))
    edge = rows.select("h").orderBy("h").limit(train_rows).agg(F.max("h")).first()[0]
    if edge is None:
        return [], np.zeros((0, (1 << bucket_bits) + 1))

    def run(parts):
        import numpy as np

        counts: dict[str, object] = {}
        for batch in parts:
            for start, stop in batches(batch.column("text")):
                langs, texts = batch.column("lang").slice(start, stop - start).to_pylist(), batch.column("text").slice(start, stop - start).to_pylist()
                for lang in sorted(set(langs)):
                    got = grams([t for t, x in zip(texts, langs) if x == lang], orders, bucket_bits)[0]
                    add = sum(np.bincount(g, minlength=(1 << bucket_bits) + 1) for g in got)
                    counts[lang] = counts[lang] + add if lang in counts else add
        for lang, n in counts.items():
            at = np.flatnonzero(n[:-1])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"])

    sums = rows.filter(F.col("h") <= edge).select("lang", "text").mapInArrow(lean(run), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    counts = np.zeros((len(langs), 1 << bucket_bits))
    for i, x in enumerate(langs):
        own = sums[sums["lang"] == x]
        counts[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    counts += smoothing
    return langs, np.hstack([np.log(counts / counts.sum(axis=1, keepdims=True)), np.zeros((len(langs), 1))])


def classify(texts: list[str], langs: list[str], matrix, orders=ORDERS, bucket_bits: int = BUCKET_BITS):
    """(language index or -1, score) a text; -1 where a text has no letter or nothing was learned. Of languages that score the
    same the first in order wins."""
    import numpy as np

    buckets, starts, letters = grams(texts, orders, bucket_bits)
    if not langs:
        return np.full(len(texts), -1), np.zeros(len(texts))
    total = np.zeros((len(langs), len(texts)))
    for g in buckets:
        for i in range(len(langs)):
            total[i] += np.add.reduceat(matrix[i][g], starts)
    total = (total - total.max(axis=0)) / len(orders)
    p = np.exp(total)
    best = total.argmax(axis=0)
    return np.where(letters > 0, best, -1), np.where(letters > 0, (p / p.sum(axis=0)).max(axis=0), 0.0)


def predict(docs: DataFrame, model: tuple[list[str], object], id_col: str = "doc_id", text_col: str = "text", orders=ORDERS, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """(id, lang_pred, score) a row; `und` with score 0 for a null text or one without a letter. Other columns are left out."""
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        langs, matrix = shared.value
        for batch in parts:
            for start, stop in batches(batch.column("text")):
                texts = [t or "" for t in batch.column("text").slice(start, stop - start).to_pylist()]
                best, score = classify(texts, langs, matrix, orders, bucket_bits)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(start, stop - start), pa.array([langs[i] if i >= 0 else UNDETERMINED for i in best], pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(lean(run), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: tuple[list[str], object], text_col: str = "text", accepted: list[str] | None = None, orders=ORDERS, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """docs without the rows whose language is undetermined or, if accepted is given, not in it. All columns stay."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        import numpy as np

        langs, matrix = shared.value
        good = np.array([accepted is None or x in accepted for x in langs] + [False])
        for batch in parts:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for start, stop in batches(texts):
                best, _ = classify([t or "" for t in texts.slice(start, stop - start).to_pylist()], langs, matrix, orders, bucket_bits)
                yield batch.slice(start, stop - start).filter(pa.array(good[best]))

    return docs.mapInArrow(lean(run), docs.schema)
