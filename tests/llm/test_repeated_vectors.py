"""Rows that repeat both id and vector take one place in a search."""

import numpy as np
from pyspark.sql import functions as F

from bylinelake.llm import vptree


def test_repeated_rows_push_out_no_neighbour(spark):
    x = np.random.default_rng(5).normal(size=(120, 8)).astype(np.float32)
    x[3] = 2 * x[0]  # the nearest row of query 0, and more often there than k
    rows = [(i, x[i].tolist()) for i in range(120)] + [(3, x[3].tolist())] * 40 + [(0, x[0].tolist())] * 25
    out = vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), F.col("id") == 0, k=20).collect()
    s = x.astype(float) @ x[0].astype(float)
    want = sorted(range(1, 120), key=lambda i: (-round(s[i], 12), i))[:20]
    assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"])] == want
