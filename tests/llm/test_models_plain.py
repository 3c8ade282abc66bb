"""The two fitted models against plain Python, and all stages on empty tables, null ids and repeated rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bylinelake.llm import langid, toxicity

LANGS = {"de": ["der Hund läuft über die Straße", "ich weiß es nicht, Öl!"], "en": ["the dog runs over the road", "I don't know it"], "fr": ["le chien court sur la route", "je ne sais pas, ça"]}


def plain_grams(text):
    """Counter of hashed n-grams: letters, all else a blank, and one before the text; those that begin with two blanks do not count."""
    c = [32] + [ord(x) if x.isalpha() else 32 for x in text.lower()]
    out = Counter()
    for n in langid.ORDERS:
        for i in range(len(c)):
            part = (c[i:] + [32] * n)[:n]
            if all(x == 32 for x in part[:2]):
                continue
            h = 0
            for x in part:
                h = (h + x + n) * 0x9E3779B97F4A7C15 % 2**64
            out[h >> 48] += 1
    return out


def test_language_model_against_plain_python(spark):
    rows = [(i, t, x) for i, (x, t) in enumerate((x, t) for x, ts in LANGS.items() for t in ts)]
    docs = spark.createDataFrame([*rows, (90, None, "de"), (91, "unlabelled", None), (92, "unused the", "en")], "doc_id long, text string, lang string")
    langs, matrix = langid.fit(docs, F.col("doc_id") != 92)
    assert langs == ["de", "en", "fr"]
    for i, x in enumerate(langs):
        n = sum((plain_grams(t) for t in LANGS[x]), Counter())
        total = sum(n.values()) + 0.5 * 65536
        for h in range(0, 65536, 997):
            assert math.isclose(matrix[i][h], math.log((n[h] + 0.5) / total), rel_tol=1e-12)
        for h in n:
            assert math.isclose(matrix[i][h], math.log((n[h] + 0.5) / total), rel_tol=1e-12)
    texts = ["die Straße", "the road", "la route", "7 8 9", "", "q"]
    for t, (best, score) in zip(texts, zip(*langid.classify(texts, langs, matrix))):
        want = [sum(k * matrix[i][h] for h, k in plain_grams(t).items()) / 3 for i in range(3)]
        if not any(x.isalpha() for x in t):
            assert (best, score) == (-1, 0.0)
            continue
        alone = langid.classify([t], langs, matrix)
        assert (alone[0][0], alone[1][0]) == (best, score)
        p = [math.exp(w - max(want)) for w in want]
        assert math.isclose(score, max(p) / sum(p), rel_tol=1e-9) and math.isclose(want[best], max(want), rel_tol=1e-12)


def test_toxicity_model_against_plain_python(spark):
    clean, bad = "the calm sea is wide and the sky is blue", "you vile filthy rat go away vile rat"
    texts = [(i, (bad + " the sea") if i % 4 == 0 else clean + f" word{i}") for i in range(80)]
    docs = spark.createDataFrame([*texts, (80, None), (81, "never labelled vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(81)] + [(82, 1), (0, None)], "doc_id long, toxic int")
    m = toxicity.fit(docs, labels, F.col("doc_id") % 10 != 9)
    n = [Counter(), Counter()]
    for i, t in texts:
        if i % 10 != 9:
            n[int(i % 4 == 0)].update(t.split())
    words = set(n[0]) | set(n[1])
    bucket = {w: int(toxicity.tokens([w])[0][0]) for w in words}
    assert len(set(bucket.values())) == len(words)
    size = 1 << toxicity.BUCKET_BITS
    alpha = {w: 0.01 * (n[0][w] + n[1][w]) + 0.25 for w in words}
    whole = [sum(n[c].values()) + 0.01 * (sum(n[0].values()) + sum(n[1].values())) + 0.25 * size for c in (0, 1)]
    delta, strong = {}, set()
    for w in words:
        odds = [math.log((n[c][w] + alpha[w]) / (whole[c] - n[c][w] - alpha[w])) for c in (0, 1)]
        delta[w] = odds[1] - odds[0]
        if abs(delta[w]) / math.sqrt(1 / (n[0][w] + alpha[w]) + 1 / (n[1][w] + alpha[w])) >= 2.6:
            strong.add(w)
    assert {"vile", "rat"} <= strong
    weak = [sum(k for w, k in n[c].items() if w not in strong) / sum(n[c].values()) for c in (0, 1)]
    pooled = min(-1e-3, math.log(weak[1] / weak[0])) if weak[0] and weak[1] else -1e-3
    for w in words:
        assert math.isclose(m["scores"][bucket[w]], delta[w] if w in strong else pooled, rel_tol=1e-9)
    expect = sum(k / sum(n[0].values()) * math.exp(m["lam"] * m["scores"][bucket[w]]) for w, k in n[0].items())
    assert m["lam"] >= 49.9 or math.isclose(expect, 1, rel_tol=1e-6)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, m).collect()}
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i, _ in texts) and 0 <= got[80] < 0.7


@pytest.fixture(scope="module")
def models(spark):
    docs = spark.createDataFrame([(0, "a b", "en"), (1, "vile c", "en")] * 3, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int")
    return langid.fit(docs, F.lit(True)), toxicity.fit(docs, labels, F.lit(True))


def test_null_and_repeated_ids_keep_their_rows(spark, models):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, None), (5, ""), (5, "x" * 200_000)], "doc_id long, text string")
    for out in (langid.predict(docs, models[0]), toxicity.score(docs, models[1])):
        assert sorted((r["doc_id"] for r in out.collect()), key=str) == [5, 5, 5, None, None]


def test_models_on_empty_tables(spark, models):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert langid.fit(none, F.lit(True))[0] == []
    m = toxicity.fit(none, labels, F.lit(True))
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert toxicity.score(docs, m).first()["score"] == 0.5 and not np.any(m["scores"])
    assert langid.predict(none, models[0]).count() == 0 and toxicity.score(none, models[1]).count() == 0


@pytest.mark.parametrize("kept", [False, True])
def test_pipeline_on_small_tables(spark, tmp_path, kept):
    """An empty table; and nulls, repeated rows and a column named like those of the stages."""
    rows = [(1, "Guten Tag", "de", "s", 9, "p"), (1, "Guten Tag", "de", "s", 9, "q"), (2, None, None, None, None, None), (3, "", "de", "s", 0, None), (None, "only words here", None, None, None, None)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string"
    spark.createDataFrame(rows if kept else [], kind).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == ({1, None} if kept else set())
