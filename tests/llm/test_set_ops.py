"""WARC, vector search, SimHash, media and the pipeline against brute force."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bylinelake.llm import avi, packing, pii, simhash, vptree, warc
from bylinelake.llm.common import salted_lookup


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "1 AS target")


def test_warc_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", ["<p>same</p>", f"<p>{i}</p>", "", None, "é" * 100][i % 5]) for i in range(40)] + [(41, None, "<b>\r\n\r\nWARC/1.1</b>" * 3000), (42, "http://x\r\ny", "tail"), (39, "http://again", "<p>39</p>"), (None, "u", "alone"), (None, "u", "<p>same</p>")]
    path = warc.write_bundles(pages_frame(spark, rows).repartition(3), f"{tmp_path}/w", frame_bytes=2000, bundle_bytes=3000)
    archives = spark.read.schema(warc.BUNDLE_SCHEMA).parquet(path)
    got = warc.read_bundles(archives).collect()
    assert len(got) == len(rows)
    payload = lambda h: (h or "").encode()
    groups = {}
    for i, _, h in rows:
        groups.setdefault(payload(h), []).append(i)
    want = []
    for i, _, h in rows:
        ids = groups[payload(h)]
        top = max([x for x in ids if x is not None], default=None)
        revisit = len(ids) > 1 and top is not None and i != top
        want.append((i, len(payload(h)), base64.b32encode(hashlib.sha1(payload(h)).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    for a in archives.collect():  # random access through the index
        assert len(warc.seek_table(bytes(a["content"]))) >= 1
        for e in a["index"]:
            head, _ = warc.read_one(bytes(a["content"]), e["frame"], e["offset"], e["length"])
            assert head["WARC-Record-ID"] == e["record_id"]
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(bytes(archives.first()["content"]), read_across_frames=True).read()
    assert whole.startswith(b"WARC/1.1")


def test_warc_min_bytes_and_empty(spark, tmp_path):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")]
    path = warc.write_bundles(pages_frame(spark, rows), f"{tmp_path}/w", min_bytes=3)
    got = {r["page_id"]: r["record_type"] for r in warc.read_bundles(spark.read.schema(warc.BUNDLE_SCHEMA).parquet(path)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    empty = warc.write_bundles(pages_frame(spark, rows).limit(0), f"{tmp_path}/e")
    assert warc.read_bundles(spark.read.schema(warc.BUNDLE_SCHEMA).parquet(empty)).count() == 0


def test_salted_lookup_is_a_left_join(spark):
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 1), (None, 3), (3, 4)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "k int, x string")
    got = sorted(map(str, salted_lookup(left, right, "k", "v").select("k", "v", "x").collect()))
    assert got == sorted(map(str, left.join(right, "k", "left").select("k", "v", "x").collect()))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS id", "2 AS score", "3 AS shard")


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[50:90] = x[50]  # ties
    rows = [(i, x[i].tolist(), 0) for i in range(400)]
    odd = [(1000, None, 0), (1020, [0.0] * 8, 0), (1040, [float("nan")] * 8, 0), (1060, [1.0, None] * 4, 0), (1080, [float("inf")] + [0.0] * 7, 0), (1100, [1.0], 0), (None, [1.0] * 8, 0), (20, x[20].tolist(), 0)]
    out = vptree.nearest(vectors(spark, rows + odd), F.col("id") % 20 == 0, k=20, shard_rows=90, leaf=8, block=7).collect()
    wide = x.astype(float)
    for q in range(0, 400, 20):
        s = wide @ wide[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-round(s[i], 12), i))[:20]
        mine = sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["vec_id"] for r in mine] == order and [r["rank"] for r in mine] == list(range(1, 21))
        assert np.allclose([r["score"] for r in mine], s[order], atol=1e-12)
    assert {r["query_id"] for r in out} == set(range(0, 400, 20))
    few = vptree.nearest(vectors(spark, rows[:3]), F.col("id") == 0, k=20).collect()
    assert len(few) == 2
    assert vptree.nearest(vectors(spark, rows[:1]).limit(0), F.col("id") == 0).count() == 0


def test_relaxed_pruning_keeps_recall():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 4
    x = np.concatenate([c + rng.normal(size=(100, 16)) for c in centres])
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids, q = np.arange(len(x)), np.arange(0, len(x), 20)
    m2 = float((x**2).sum(axis=1).max())
    tree = vptree.build(np.hstack([x, np.sqrt(np.maximum(m2 - (x**2).sum(axis=1), 0))[:, None]]), 64)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    true = [set(r) for r in np.argsort(-s, axis=1)[:, :20]]
    seen = []
    for factor in (1.0, 0.5):
        a, b, _, visited = vptree.search(x, ids, tree, m2, x[q], q, 20, factor)
        seen.append((np.mean([len(true[i] & set(b[a == i])) / 20 for i in range(len(q))]), visited))
    assert seen[0][0] == 1.0 and seen[1][0] >= 0.9 and seen[1][1] < seen[0][1]


def brute_fingerprint(text, k):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_classes(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if linked(a, b):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 60, 300]))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("run", [4096, 4])
def test_simhash_equals_brute_force(spark, docs, monkeypatch, run):
    monkeypatch.setattr(simhash, "RUN", run)
    texts = [None, "", " \t\n", "ONE Two", "one two", "É a b", "a b " * 40000] + near_texts(1, 60)
    out = simhash.near_duplicates(docs(texts).repartition(3)).collect()
    fps = [brute_fingerprint(t, 3) for t in texts]
    want = brute_classes(list(range(len(texts))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == {i: (f"{fps[i]:016x}", want[i]) for i in want}
    assert simhash.near_duplicates(docs(["x"]).limit(0)).count() == 0


def test_finer_masks_lose_nothing(spark, monkeypatch):
    """A dense cluster: every run is longer than RUN, so links come from finer and finer masks."""
    monkeypatch.setattr(simhash, "RUN", 30)
    rng = random.Random(4)
    fps = sorted({rng.getrandbits(64) if i % 9 == 0 else sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for i in range(120)})
    nodes = spark.createDataFrame([(i, [f - (1 << 64) if f >> 63 else f]) for i, f in enumerate(fps)], "node long, fp array<bigint>")
    root = {r["node"]: r["root"] for r in simhash.components(simhash.links_within(nodes, 3)).collect()}
    want = brute_classes(list(range(len(fps))), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {i: root.get(i, i) for i in want} == want


def test_masks_cover_all_close_pairs():
    rng, masks = random.Random(6), simhash.pigeonhole_masks(3, 3)
    assert len(masks) == 20
    for _ in range(500):
        x = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not x & m for m in masks)
        assert any(not x & f for m in masks if not x & m for f in simhash.finer_masks(m, 3))


def test_components_of_paths(spark):
    rng, n = random.Random(3), 200
    order = list(range(n))
    rng.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1) if i % 50 != 49]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {v: min(order[i // 50 * 50 : i // 50 * 50 + 50]) for i, v in enumerate(order)}
    assert {v: got.get(v, v) for v in order} == want


def jaccard(a, b):
    s, t = (set(simhash.shingle_hashes(x, 5).tolist()) for x in (a, b))
    return len(s & t) / max(1, len(s | t))


def test_near_copies_against_brute_force(spark, docs):
    """Over edits from one word to one in thirty: what goes has a similar text, and nearly all similar texts go."""
    rng, texts = random.Random(12), []
    for i in range(60):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(40, 400))]
        copy = list(base)
        for _ in range(1 + len(base) * (i % 4) // 90):
            copy[rng.randrange(len(copy))] = "changed"
        texts += [" ".join(base), " ".join(copy)]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs(texts)).collect()}
    close = [i for i in range(0, 120, 2) if jaccard(texts[i], texts[i + 1]) >= 0.8]
    gone = set(range(120)) - kept
    assert gone <= {i + 1 for i in close} and len(close) > 20
    assert len(gone) >= 0.9 * len(close)


def test_similar_texts_drop_to_one(spark, docs):
    rng = random.Random(9)
    base = [[f"u{rng.randrange(5000)}" for _ in range(400)] for _ in range(40)]
    texts, similar = [], []
    for b in base:
        c = list(b)
        for _ in range(3):  # 400 words, three changes: a similarity of about 0.93
            c[rng.randrange(400)] = "zzz"
        texts += [" ".join(b), " ".join(c).upper()]
    texts += [texts[0], "", None]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs(texts, list(range(len(texts) - 1)) + [None])).collect()}
    originals = set(range(0, 80, 2))
    assert originals <= kept and 80 not in kept and {81, None} <= kept
    assert len(kept & set(range(1, 80, 2))) <= 2
    twice = docs(["a b c d e f", "a b c d e f"], [7, 7])
    assert simhash.drop_near_duplicates(twice).count() == 2


TEXTS = [None, "", "a", "x" * 64, "é" * 300, "word " * 9000, "日本語"]


def test_media_round_trip(docs):
    out = {r["doc_id"]: r for r in avi.text_media(docs(TEXTS + ["a"]), with_media=True).collect()}
    for i, t in enumerate(TEXTS + ["a"]):
        raw = (t or "").encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = out[i]
        media = bytes(r["media"])
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        assert media[:4] == b"RIFF" and b"MJPG" in media and avi.load(media)[0] == payload
    assert out[2]["feature"] == out[7]["feature"]
    assert avi.text_media(docs(["x"]).limit(0)).count() == 0


def test_fast_and_general_decoding_agree():
    payload = bytes(random.Random(1).randrange(256) for _ in range(64 * 24))  # with stuffed bytes
    jpeg = avi.parse_jpeg(avi.coefficient_frames(payload, 24, 8, 3)[0])
    stored = avi.frame_bytes(jpeg)
    assert stored.tobytes() == payload
    assert (avi.luma(jpeg, stored) == avi.luma(jpeg)).all()


def test_general_decoder_reads_ordinary_codes():
    """A frame with several code lengths, run lengths, end of block and no restart markers, coded here bit by bit."""
    rng = random.Random(2)
    blocks = [[rng.randrange(-60, 60)] + [rng.choice([0, 0, 0, 1, -2, 5]) if k < 30 else 0 for k in range(1, 64)] for _ in range(6)]
    symbols = {0: list(range(8)), 16: [0, 0xF0] + [r << 4 | s for r in range(16) for s in (1, 2, 3)]}
    tables = {t: (bytes([0] * 7 + [len(v)] + [0] * 8), bytes(v)) for t, v in symbols.items()}
    codes = {t: {s: n for (_, n), s in avi._huffman(*v).items()} for t, v in tables.items()}
    bits, last = "", 0

    def value(v):
        n = abs(v).bit_length()
        return n, f"{v if v > 0 else v + (1 << n) - 1:0{n}b}" if n else ""

    for b in blocks:
        n, extra = value(b[0] - last)
        last, run = b[0], 0
        bits += f"{codes[0][n]:08b}" + extra
        end = max((k for k in range(1, 64) if b[k]), default=0)
        for k in range(1, end + 1):
            if not b[k]:
                run += 1
                continue
            while run > 15:
                bits += f"{codes[16][0xF0]:08b}"
                run -= 16
            n, extra = value(b[k])
            bits += f"{codes[16][run << 4 | n]:08b}" + extra
            run = 0
        if end < 63:
            bits += f"{codes[16][0]:08b}"
    bits += "1" * (-len(bits) % 8)
    data = int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\0")
    jpeg = {"height": 16, "width": 24, "parts": [(1, 1, 1, 0)], "q": {0: [1] * 64}, "huff": tables, "restart": 0, "scan": {1: (0, 0)}, "data": data}
    assert avi._coefficients(jpeg)[1].reshape(-1, 64).tolist() == blocks


def test_clips(spark):
    dark, light = bytes([0] * 64), bytes([128] + [0] * 63)
    frames = [f for b in (dark * 64, bytes(range(64)) * 64) for f in avi.coefficient_frames(b, 64, 8, 8) * 10]
    media = avi.write_avi(frames, 64, 64, fps=10)
    assert light and avi.read_avi(media)["fps"] == 10
    got = avi.clips(spark.createDataFrame([(1, bytearray(media)), (2, None), (3, bytearray(avi.write_avi([], 8, 8)))], "id long, media binary")).collect()
    assert [(r["id"], r["first_frame"], r["stop_frame"], r["start_s"], r["stop_s"]) for r in got] == [(1, 0, 10, 0.0, 1.0), (1, 10, 20, 1.0, 2.0)]


def test_pipeline_against_brute_force(spark, tmp_path, tokenizer):
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng = random.Random(5)
    english, german = "the of and house tree walk blue green idea word".split(), "der die das und nicht mit haus baum gehen blau".split()
    rows, toxic = [], []
    for i in range(240):
        words = [rng.choice(english if i % 3 else german) + str(rng.randrange(30)) for _ in range(rng.randrange(60, 200))]
        if i % 6 == 0:
            for _ in range(8):
                words[rng.randrange(len(words))] = rng.choice(["scumbag", "vileone"])
            toxic.append(i)
        rows.append((i, " ".join(words), "en" if i % 3 else "de"))
    clean = [i for i in range(240) if i not in toxic]
    rows += [(300, "12345 !!", "en"), (301, None, "en"), (302, rows[clean[0]][1], "en"), (303, rows[clean[1]][1].upper(), "en"), (304, "pay 4111111111111111 now please my dear friend of mine", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = sorted({r["doc_id"] for r in out})
    assert kept == sorted([*clean, 304])
    library = Tokenizer.from_file(tokenizer)
    texts = dict((i, t) for i, t, _ in rows)
    texts[304] = pii.pseudonymise(docs.filter("doc_id = 304"), corpus_pipeline.PII_KEY).first()["text"]
    assert "4111111111111111" not in texts[304]
    lengths = {i: len(library.encode(texts[i], add_special_tokens=False).ids) + 1 for i in kept}
    got = {}
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == lengths
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_near_dedup", "pii_pseudonyms", "packing"]
    assert packing.plan({}, 16) == []
