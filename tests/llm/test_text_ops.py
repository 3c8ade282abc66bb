"""BPE, packing, language ID, toxicity, licences and personal values against brute force."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bylinelake.llm import bpe, langid, licenses, packing, pii, queries, toxicity

TEXTS = [None, "", "  \n", "The Cat's 12 cats'll SAT!!! <|endoftext|> éÀß ﬁ İ Σς", "x" * 5000, "ab" * 3000 + " tail", "日本語 テキスト ́", "tab\tand nbsp\x1c", "word " * 30000, "same", "same"]


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def test_bpe_equals_the_library(docs, tokenizer, library):
    out = bpe.encode_decode(docs(TEXTS), tokenizer, outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(out) == len(TEXTS)
    for r, t in zip(sorted(out, key=lambda r: r["doc_id"]), TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = struct.pack(f"<{len(ids)}I", *ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], bytes(r["ids"]), r["decoded"]) == (len(ids), raw, decoded)
        assert (r["ids_sha256"], r["decoded_sha256"]) == (hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert bpe.encode_decode(docs(["x"]).limit(0), tokenizer).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abthein'é!# 7Àß\ń日"), max_size=400), st.sampled_from([2, 3, 7, 64]))
def test_tree_concatenation(text, leaf):
    import public_tokenizers as P

    own = bpe.encoder(P.path("word_bpe_49k.json"), 4, leaf)
    assert own.encode(text).tolist() == own.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("word", ["a" * 999, "ab" * 700, "aab" * 500, "".join(random.Random(5).choice("thean") for _ in range(4000))])
def test_tree_on_long_words(word, tokenizer, library):
    own = bpe.encoder(tokenizer, 16, 32)
    assert own.encode_word(word.encode()).tolist() == library.encode(word, add_special_tokens=False).ids


def check_packing(rows, texts, library, window, end_id):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert len(by_doc) == len(texts)
    for i, t in enumerate(texts):
        ids, at = [*library.encode(t or "", add_special_tokens=False).ids, end_id], 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            piece = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
            if "ids" in r.asDict():
                assert bytes(r["ids"]) == struct.pack(f"<{len(piece)}I", *piece)
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
        total += at
    return padding / total


@pytest.mark.parametrize("with_ids", [False, True])
def test_packing_covers_every_token(docs, tokenizer, library, with_ids):
    rng = random.Random(2)
    texts = TEXTS + [" ".join(rng.choice(["the", "cat", "sits", "qzx"]) for _ in range(rng.randrange(1, 400))) for _ in range(120)]
    rows = packing.pack(docs(texts).repartition(3), tokenizer, window=256, end_id=1, with_ids=with_ids).collect()
    assert check_packing(rows, texts, library, 256, 1) < 0.05
    assert packing.pack(docs(["x"]).limit(0), tokenizer).count() == 0


def test_packing_cuts_what_no_combination_takes(docs, tokenizer, library):
    texts = ["cat " * 149] * 40
    assert check_packing(packing.pack(docs(texts), tokenizer, window=256).collect(), texts, library, 256, 1) < 0.05


def test_least_squares():
    combos = packing.combinations(16, 3)
    assert all(sum(c) == 16 for c in combos) and len(set(combos)) == len(combos)
    assert set(combos) == {t for t in combos} and (8, 8) in combos and (6, 5, 5) in combos
    stock = {b: n for b, n in enumerate([0, 5, 9, 7, 3, 8, 2, 9, 10, 4, 6, 7, 5, 3, 2, 6, 11]) if n}
    used = {}
    for pattern, n in packing.plan(stock, 16, 3):
        assert sum(pattern) == 16
        for b in pattern:
            used[b] = used.get(b, 0) + n
    assert all(n <= stock[b] for b, n in used.items())
    rng = np.random.default_rng(0)
    target = rng.integers(0, 50, 16).astype(float)
    x = packing.nnls(combos, target)
    A = np.zeros((16, len(combos)))
    for j, c in enumerate(combos):
        for b in c:
            A[b, j] += 1
    gradient = A.T @ (A @ x - target)
    assert (x >= 0).all() and gradient.min() > -1e-6 and abs(gradient[x > 1e-9]).max() < 1e-6


def test_language(spark, sf):
    out = queries.op3_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out["held_out"]]
    assert len(out) == 200 and (held["lang"] == held["lang_pred"]).mean() > 0.95 and out["score"].between(0, 1).all()


def test_language_edges(spark, docs):
    rows = [(i, t, x) for i, (t, x) in enumerate([("der die das und nicht", "de"), ("the cat and the dog", "en"), (None, "en"), ("x", None)])]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(train, F.lit(True))
    assert model[0] == ["de", "en"]
    odd = docs(["The dog", None, "", "123 !!", "die und\n" * 50000])
    assert [r["lang_pred"] for r in langid.predict(odd, model).orderBy("doc_id").collect()] == ["en", "und", "und", "und", "de"]
    assert [r["doc_id"] for r in langid.keep_identified(odd, model).orderBy("doc_id").collect()] == [0, 4]
    none = langid.fit(train.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(odd, none).collect()} == {"und"}
    texts, total = ["the cat", "die und"], []
    buckets, starts, _ = langid.grams(texts)
    for i, t in enumerate(texts):  # one text at a time, bucket by bucket
        own = [b for g in langid.grams([t])[0] for b in g]
        total.append([sum(model[1][k][b] for b in own) for k in range(2)])
    best, _ = langid.classify(texts, *model)
    assert best.tolist() == [int(np.argmax(x)) for x in total]


def brute_segments(x):
    best = max(((sum(x[i:j]), i - j, i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return brute_segments(x[:i]) + [(i, j)] + [(a + j, b + j) for a, b in brute_segments(x[j:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([-3.01, -1.003, 1.0007, 2.00011, -2.000013, 5.0000017]), max_size=12))
def test_segments(x):
    assert [(a, b) for a, b, _ in toxicity.segments(np.array(x, float))] == brute_segments(x)


def test_toxicity(spark, docs):
    rng = random.Random(1)
    plain = [" ".join(rng.choice("the of and house tree walk blue green idea".split()) for _ in range(80)) for _ in range(300)]
    bad = [t + " you vile scumbag vile scumbag " + t for t in plain[:40]]
    rows = [(i, t) for i, t in enumerate(bad + plain)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40), 1) for i in range(340)] + [(None, 1, 1), (5, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(train, labels, F.lit(True))
    odd = docs(["a vile scumbag and a vile scumbag", "the house", None, "", "tree " * 60000 + "vile scumbag vile scumbag"])
    got = toxicity.score(odd, model).orderBy("doc_id").collect()
    assert got[0]["score"] >= 0.7 and len(got[0]["passages"]) >= 1
    assert all(g["score"] < 0.7 and not g["passages"] for g in got[1:4]) and got[4]["passages"]
    assert [r["doc_id"] for r in toxicity.drop_toxic(odd, model).orderBy("doc_id").collect()][:3] == [1, 2, 3]
    empty = toxicity.fit(train.limit(0), labels, F.lit(True))
    assert {r["score"] for r in toxicity.score(odd, empty).collect()} == {0.5}


def test_tokens_match_words():
    import re

    texts = ["", "It's a TEST, émile 42!", " ... ", "a b"]
    b, ptr = toxicity.tokens(texts)
    words = [re.findall(r"[a-z0-9'\x80-￿]+", t.lower()) for t in texts]
    assert np.diff(ptr).tolist() == [len(w) for w in words]
    assert b.tolist() == [toxicity.tokens([x])[0][0] for w in words for x in w]


def test_licences(docs):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT")
    texts = ["Copyright (c) 2020 A B\n\nThe MIT Licence\n" + mit.upper(), mit + " and more", "x\n  Released under the MIT license\nReleased under the MIT License.", None, "", "SPDX-License-Identifier: Zlib", "word " * 50000]
    out = {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan(docs(texts)).collect()}
    assert out == {0: ("MIT", ""), 1: (None, ""), 2: (None, "MIT"), 3: (None, ""), 4: (None, ""), 5: ("Zlib", "Zlib"), 6: (None, "")}
    for name, text in licenses.KNOWN:
        assert licenses.known_digests()[licenses.digest(text)] == name


PII = {
    "mail a.b@x.org.": r"^mail [a-z0-9]\.[a-z0-9]@x\.org\.$",
    "card 4111111111111111 end": r"^card \d{16} end$",
    "call +1 (974) 555-3436": r"^call \+1 \(\d{3}\) \d{3}-\d{4}$",
    "ip 10.2.3.4, ok": r"^ip \d+\.\d+\.\d+\.\d+, ok$",
    "born 2024-02-29": r"^born \d{4}-\d\d-\d\d$",
    "on 31.12.1999 at": r"^on \d\d\.\d\d\.\d{4} at$",
    "ssn 123-45-6789": r"^ssn \d{3}-\d\d-\d{4}$",
}
KEPT = ["4111111111111112", "2023-02-29", "300.1.1.1", "000-12-1234", "no digits", "x@", "version 1.2", "", "12345"]


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_personal_values(docs):
    import datetime
    import re

    texts = [*PII, *KEPT, None, "4111111111111111 " * 3 + "4111 1111 1111 1111", "word 4111111111111111 " * 2000]
    out = [(r["text"], r["n"]) for r in pii.pseudonymise(docs(texts), "k", "text", "n").orderBy("doc_id").collect()]
    for (new, n), (old, pattern) in zip(out, PII.items()):
        assert re.match(pattern, new) and new != old and n == 1, (old, new)
    assert luhn(re.search(r"\d{16}", out[1][0])[0])
    assert all(int(x) < 256 for x in re.findall(r"\d+", out[3][0]))
    datetime.date.fromisoformat(out[4][0][5:])
    k = len(PII)
    assert out[k : k + len(KEPT)] == [(t, 0) for t in KEPT] and out[k + len(KEPT)] == (None, 0)
    card = re.search(r"\d{16}", out[1][0])[0]
    assert out[-2][0] == f"{card} " * 3 + " ".join(card[i : i + 4] for i in (0, 4, 8, 12)) and out[-1] == (f"word {card} " * 2000, 2000)
    assert pii.pseudonymise(docs(["x"]).limit(0), "k").count() == 0
    other = pii.pseudonymise(docs(["4111111111111111"]), "another").first()["text"]
    assert other != card


def python_feistel(s, alphabet, key, kind):
    a, b = s[: len(s) // 2], s[len(s) // 2 :]
    for i in range(1, pii.ROUNDS + 1):
        h = hashlib.sha256(f"{key}|{kind}|{i}|{len(s)}|{b}".encode()).hexdigest()
        a, b = b, "".join(alphabet[(alphabet.index(c) + int(h[2 * j : 2 * j + 2], 16)) % len(alphabet)] for j, c in enumerate(a))
    return a + b


def test_feistel_is_a_permutation(spark):
    x = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s")).select("s", pii.feistel(F.col("s"), pii.DIGITS, "k", "t").alias("p")).collect()
    assert len({r["p"] for r in x}) == 1000 and all(r["p"] == python_feistel(r["s"], pii.DIGITS, "k", "t") for r in x)
    d = spark.range(pii.DAYS).select(pii.pair_feistel(F.floor(F.col("id") / pii.DATE_RIGHT), F.col("id") % pii.DATE_RIGHT, pii.DATE_LEFT, pii.DATE_RIGHT, "k", "d").alias("p"))
    assert d.agg(F.count_distinct("p")).first()[0] == pii.DAYS
