"""SimHash near-duplicates: fingerprints, pigeonhole block tables, Hamming verification, connected components.

A fingerprint bit is set if it is set in over half of the hashes of a document's word shingles. Fingerprints within `max_bits`
share all bits of one key mask at least, so equal (mask, key) rows meet in one run of a sorted partition, where they are
verified and only a forest of links leaves the task. Every table is by distinct fingerprint, so copies cost nothing, and
the links never meet on the driver.

drop_near_duplicates goes by the Jaccard similarity of shingle sets: SimHash links of the sets are checked on the texts, and
an exact join finds the pairs that fingerprints miss: sets that are similar share one of their rarest shingles (prefix
filter), pairs of equal shingles are sifted by a bound that loses none, and what is left is checked.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, lean, salted_lookup, written

#: Runs of up to so many fingerprints are compared pairwise in one task.
RUN = 4096
#: Rows of least hash whose shingles are counted to order shingles by rarity. Any order gives the same result.
ORDER_ROWS = 10_000
#: 64-bit words of a set's parity sketch.
SKETCH = 8
#: Links that are checked together, and the most rows of a lookup of texts that are broadcast.
BUCKET, BROADCAST_ROWS = 256, 500_000
#: With so many bits outside the mask a run has at most 2 ** FEW_BITS fingerprints, all different, and is never split.
FEW_BITS = 12


def shingle_hashes(text: str, size: int):
    """XXH64 (seed 42) of each shingle of `size` words, A-Z lower-cased and split at ASCII white space; repeats stay."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= size:
        return np.array([h(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([h(joined[a:b], 42) for a, b in zip(starts[: 1 - size or None].tolist(), ends[size - 1 :].tolist())], np.uint64)


def fingerprint(hashes, words: int = 1):
    """`words` 64-bit words: bit set if set in over half the hashes. Word 0 votes with the hashes, others with remixes."""
    import numpy as np

    total = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), 4080):
        h = hashes[at : at + 4080]
        many = np.empty((len(h), words), ">u8")
        for j in range(words):
            x = h
            if j:
                x = h + np.uint64((j * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x = x ^ (x >> np.uint64(31))
            many[:, j] = x
        bits = np.unpackbits(many.view(np.uint8).reshape(len(h), 8 * words), axis=1)
        for k in range(0, len(bits), 255):  # byte sums cannot overflow
            total += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return np.packbits(total * 2 > len(hashes)).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, size: int, words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp array<long>) a document; no words (or a null text) give fingerprint zero."""
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts):
        import numpy as np

        for batch in parts:
            fps = np.array([fingerprint(shingle_hashes(t.as_py() or "", size), words) for t in batch.column("text")], np.uint64).reshape(-1, words)
            flat = pa.array(fps.ravel().view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, words, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "fp"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(lean(run), f"id {kind}, fp array<bigint>")


def pigeonhole_masks(max_bits: int, shared: int = 3) -> list[int]:
    """Masks over 64 bits, each a choice of `shared` of max_bits + shared blocks: fingerprints within max_bits agree on one."""
    n = max_bits + shared
    cuts = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(n)]
    return [sum(c) for c in itertools.combinations(blocks, shared)]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """Cut the bits outside mask into max_bits + 1 parts and add each to mask: close fingerprints agree on one of them."""
    free = [i for i in range(64) if not mask >> i & 1]
    n = max_bits + 1
    return [mask | sum(1 << b for b in free[len(free) * i // n : len(free) * (i + 1) // n]) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps, nodes, max_bits: int):
    """Links (larger node, smaller node) that connect the rows within max_bits as all pairs would; one run of a table."""
    import numpy as np

    parent = np.arange(len(nodes))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(nodes) - 1):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]).sum(axis=1, dtype=np.int64) <= max_bits)
        if len(near):
            a = find(i)
            for j in (near + i + 1).tolist():
                parent[find(j)] = a
    roots = np.array([find(i) for i in range(len(nodes))])
    order = np.lexsort((nodes, roots))
    first = np.concatenate([[True], roots[order][1:] != roots[order][:-1]])
    head = nodes[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    return nodes[order][~first], head[~first]


def _link_runs(rows: DataFrame, words: int, max_bits: int) -> DataFrame:
    """(a, b, fp, mask): links of each (mask, key) run, or the rows of a run longer than RUN as fp and mask with b null.

    Links are a forest that connects as all pairs would.
    """
    import pyarrow as pa

    spread = rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")

    def run(parts):
        import numpy as np

        carry = None
        for batch in itertools.chain(parts, [None]):
            if batch is not None:
                if not len(batch):
                    continue
                fps = batch.column("fp").flatten().to_numpy().view(np.uint64).reshape(-1, words)
                now = [batch.column(c).to_numpy() for c in ("mask", "key", "node")] + [fps]
                now = now if carry is None else [np.concatenate(x) for x in zip(carry, now)]
            elif carry is None:
                return
            else:
                now = carry
            mask, key, node, fps = now
            edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            starts, stops = np.concatenate([[0], edge]), np.concatenate([edge, [len(mask)]])
            keep = len(mask)
            if batch is not None:  # the last run may go on
                keep = starts[-1]
                starts, stops = starts[:-1], stops[:-1]
            carry = [x[keep:] for x in now] if batch is not None else None
            got_a, got_b, hot = [], [], []
            many = stops - starts > 1
            pair = many & (stops - starts == 2)
            p = starts[pair]
            near = np.bitwise_count(fps[p] ^ fps[p + 1]).sum(axis=1, dtype=np.int64) <= max_bits if len(p) else np.empty(0, bool)
            got_a.append(np.maximum(node[p], node[p + 1])[near])
            got_b.append(np.minimum(node[p], node[p + 1])[near])
            for s, e in zip(starts[many & ~pair].tolist(), stops[many & ~pair].tolist()):
                if e - s > RUN and 64 - (int(mask[s]) & (1 << 64) - 1).bit_count() > FEW_BITS:
                    hot.append(np.arange(s, e))
                    continue
                a, b = _forest(fps[s:e], node[s:e], max_bits)
                got_a.append(a)
                got_b.append(b)
            a, b = np.concatenate(got_a), np.concatenate(got_b)
            a, b = a[(real := a != b)], b[real]
            h = np.concatenate(hot) if hot else np.empty(0, np.int64)
            flat = np.concatenate([np.zeros(len(a) * words, np.uint64), fps[h].ravel()]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, words, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, node[h]]), pa.int64()), pa.array([*b.tolist(), *[None] * len(h)], pa.int64()), lists, pa.array(np.concatenate([np.zeros(len(a), np.int64), mask[h]]), pa.int64())], names=["a", "b", "fp", "mask"])

    return spread.mapInArrow(lean(run), "a long, b long, fp array<bigint>, mask long")


def links_within(nodes: DataFrame, max_bits: int, shared: int = 3) -> DataFrame:
    """Links (a, b) between 64-bit fingerprints within max_bits, exactly; nodes: (node long, fp array<long> of one).

    Runs longer than RUN go on to finer masks (of the bits outside the mask, max_bits + 1 parts) until FEW_BITS are left;
    close fingerprints agree on one of the parts, so this ends and loses nothing.
    """
    spark = nodes.sparkSession
    masks, found = pigeonhole_masks(max_bits, shared), []
    fp = F.col("fp")[0]
    rows = nodes.withColumn("mask", F.explode(F.array(*(F.lit(_signed(m)).cast("long") for m in masks))))
    while True:
        out = written(_link_runs(rows.withColumn("key", fp.bitwiseAND(F.col("mask"))), 1, max_bits), "links")
        found.append(out.filter("b IS NOT NULL").select("a", "b"))
        hot = out.filter("b IS NULL")
        todo = [r["mask"] & (1 << 64) - 1 for r in hot.select("mask").distinct().collect()]  # at most one a mask
        if not todo:
            break
        finer = spark.createDataFrame([(_signed(m), [_signed(f) for f in finer_masks(m, max_bits)]) for m in todo], "mask long, finer array<bigint>")
        rows = hot.select(F.col("a").alias("node"), "fp", "mask").join(F.broadcast(finer), "mask").select("node", "fp", F.explode("finer").alias("mask"))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each linked node, by alternating large and small stars."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(now)
        least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
        large = salted_lookup(edges, least, "b", "a").select("a", F.coalesce("m", "b").alias("b")).distinct()
        own = large.withColumn("m", F.min("b").over(Window.partitionBy("a")))  # a node keeps at most one link a table
        pairs = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = written(own.select(F.explode(pairs).alias("e")).select("e.*").filter("a <> b").distinct(), "edges")


def classes(fps: DataFrame, link) -> DataFrame:
    """(id, fp, component): fps (id, fp) and the smallest id reachable over equal fingerprints and the links of `link`.

    Null ids take no part and get a null component.
    """
    nodes = written(fps.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("node")), "nodes")
    roots = components(link(nodes.select(F.col("node").cast("long"), "fp")))
    named = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component"))
    out = salted_lookup(fps, named, "fp", "id")
    return out.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) a row: 64-bit fingerprints linked at max_bits or fewer differing bits.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows stay; an empty table gives none.
    """
    fps = written(fingerprints(docs, size, 1, id_col, text_col), "fingerprints")
    out = classes(fps, lambda nodes: links_within(nodes, max_bits))
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex(F.col("fp")[0])), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def shingle_set(text: str, size: int):
    """The distinct shingle hashes of a text, in order."""
    import numpy as np

    return np.unique(shingle_hashes(text, size))


def set_rows(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp array<long> of two, sign, n, sketch, fine) a document: of its set of shingles the 128-bit digest, the 64-bit
    SimHash, the size, and for each of 64 * SKETCH bits whether an odd number of shingles fall there. Sets differ in as
    many shingles at least as their sketches differ in bits. fine is a longer sketch, of two to four bits a shingle."""
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts):
        import numpy as np
        import xxhash

        for batch in parts:
            sets = [shingle_set(t.as_py() or "", size) for t in batch.column("text")]
            digests = pa.array(np.concatenate([np.empty(0, np.int64), *(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8") for s in sets)]))
            signs = np.array([fingerprint(s)[0] for s in sets], np.uint64)
            lists = lambda flat, k: pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k, dtype=np.int32)), flat)
            sketches = pa.array(np.concatenate([np.empty(0, np.int64), *(parities(s, SKETCH) for s in sets)]))
            fine = [parities(s, max(SKETCH, 1 << max(0, 2 * len(s) - 1).bit_length() >> 6)) for s in sets]
            long = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, fine)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *fine])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists(digests, 2), pa.array(signs.view(np.int64)), pa.array([len(s) for s in sets], pa.int64()), lists(sketches, SKETCH), long], names=["id", "fp", "sign", "n", "sketch", "fine"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lean(run), f"id {kind}, fp array<bigint>, sign long, n long, sketch array<bigint>, fine array<bigint>")


def parities(s, words: int):
    """`words` (a power of two) 64-bit words: whether an odd number of the set's hashes fall on each bit."""
    import numpy as np

    odd = np.bincount((s & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix(s, common, counts, similarity: float):
    """The first shingles of a set by (count, hash), so many that sets of this similarity or more share one at least."""
    import numpy as np

    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        s = s[np.lexsort((s, np.where(common[at] == s, counts[at], 0)))]
    return s[: len(s) - math.ceil(similarity * len(s) - 1e-9) + 1]


def shared_prefixes(docs: DataFrame, n_docs: int, size: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(key, name): the prefix shingles that two or more different sets have; name is the first word of a set's digest."""
    import pyarrow as pa

    scale = 1 << 20
    share = min(scale, math.ceil(scale * ORDER_ROWS / max(1, n_docs)))
    texts = docs.filter(F.col(id_col).isNotNull()).select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def every(parts):
        import numpy as np

        for batch in parts:
            sets = [shingle_set(t.as_py() or "", size) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))], names=["key"])

    sample = texts.filter(F.pmod(F.xxhash64("id"), F.lit(scale)) < share).mapInArrow(lean(every), "key long")
    top = sample.groupBy("key").count().filter("count >= 3").orderBy(F.desc("count"), "key").limit(100_000).toArrow()
    order = docs.sparkSession.sparkContext.broadcast([top.column(c).to_numpy().tobytes() for c in ("key", "count")])

    def keys(parts):
        import numpy as np
        import xxhash

        common, counts = (np.frombuffer(x, kind) for x, kind in zip(order.value, (np.uint64, np.int64)))
        by_key = np.argsort(common)
        common, counts = common[by_key], counts[by_key]
        for batch in parts:
            got, names = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for t in batch.column("text"):
                s = shingle_set(t.as_py() or "", size)
                if len(s):
                    got.append(prefix(s, common, counts, similarity))
                    names.append(np.full(len(got[-1]), np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")[0]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got).view(np.int64)), pa.array(np.concatenate(names))], names=["key", "name"])

    def shared(parts):
        import numpy as np

        held, out = None, False  # the last row so far, and whether it has gone out
        for batch in itertools.chain(parts, [None]):
            if batch is not None and not len(batch):
                continue
            if batch is None:
                return
            key, name = (batch.column(c).to_numpy() for c in ("key", "name"))
            if held is not None:
                key, name = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], name])
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])
            key, name = key[fresh], name[fresh]
            same = key[1:] == key[:-1]
            goes = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            was, out, held = out, bool(goes[-1]) or (len(key) == 1 and held is not None and out), (key[-1], name[-1])
            goes[0] &= not was
            yield pa.RecordBatch.from_arrays([pa.array(key[goes], pa.int64()), pa.array(name[goes], pa.int64())], names=["key", "name"])

    rows = texts.mapInArrow(lean(keys), "key long, name long")
    return rows.repartition("key").sortWithinPartitions("key", "name").mapInArrow(lean(shared), "key long, name long")


def _stars(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): each row (key, u, hub, n, sketch) with the one of most hub and with the one before it of the same key, if
    sizes and sketches allow the similarity."""
    import pyarrow as pa

    def run(parts):
        import numpy as np

        held = None  # key, u, n, sketch of the first and of the last row of the run that goes on
        for batch in parts:
            if not len(batch):
                continue
            now = [batch.column(c).to_numpy() for c in ("key", "u", "n")] + [batch.column("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH)]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            key, u, n, bits = now
            new = np.concatenate([[True], key[1:] != key[:-1]])
            head = np.maximum.accumulate(np.where(new, np.arange(len(u)), 0))
            at = np.flatnonzero(~new)
            two = np.concatenate([np.stack([at, head[at]], axis=1), np.stack([at, at - 1], axis=1)])
            x, y = two[:, 0], two[:, 1]
            near = (u[x] != u[y]) & _may_be(n[x], n[y], bits[x] ^ bits[y], similarity)
            two = np.unique(np.sort(u[two[near]], axis=1)[:, ::-1], axis=0)
            held = [c[[head[-1], -1]] for c in now]
            yield pa.RecordBatch.from_arrays([pa.array(two[:, 0], pa.int64()), pa.array(two[:, 1], pa.int64())], names=["a", "b"])

    spread = rows.repartition("key").sortWithinPartitions("key", F.desc("hub"), "u")
    return spread.mapInArrow(lean(run), "a long, b long")


def _may_be(n, m, differ, similarity: float):
    """Whether sets of n and m shingles, whose sketches' exclusive or is `differ`, can be similar enough."""
    import numpy as np

    sizes = np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9
    return sizes & (np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= (1 - similarity) / (1 + similarity) * (n + m) + 1e-9)


def _mixed(rows: DataFrame) -> DataFrame:
    """(key, u) of the keys that rows (key, u, label) of more than one label have."""
    import pyarrow as pa

    def run(parts):
        import numpy as np

        last, label0, open_mixed, held = None, 0, False, []
        for batch in parts:
            if not len(batch):
                continue
            key, u, label = (batch.column(c).to_numpy() for c in ("key", "u", "label"))
            goes_on = last is not None and key[0] == last
            new = np.concatenate([[not goes_on], key[1:] != key[:-1]])
            run_no = np.cumsum(new) - (0 if goes_on else 1)
            first = label[new] if not goes_on else np.concatenate([[label0], label[new]])
            mixed = np.bincount(run_no, label != first[run_no], minlength=len(first)) > 0
            if goes_on:
                mixed[0] |= open_mixed
            got_k, got_u = [key[mixed[run_no]]], [u[mixed[run_no]]]
            if goes_on and mixed[0] and held:
                got_k.append(np.full(sum(map(len, held)), last))
                got_u.extend(held)
            tail = u[run_no == run_no[-1]]
            if mixed[-1]:
                held = []
            else:
                held = [*held, tail] if goes_on and run_no[-1] == 0 else [tail]
            last, label0, open_mixed = key[-1], first[-1], bool(mixed[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got_k), pa.int64()), pa.array(np.concatenate(got_u), pa.int64())], names=["key", "u"])

    return rows.repartition("key").sortWithinPartitions("key", "label").mapInArrow(lean(run), "key long, u long")


def _pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of a (key, c1, c2) run that are of two labels and, by size and sketch, may be similar enough.

    Of a run of two parts, c1 and c2, only pairs across them."""
    import pyarrow as pa

    def run(parts):
        import numpy as np

        carry = None
        for batch in itertools.chain(parts, [None]):
            if batch is not None:
                if not len(batch):
                    continue
                now = [batch.column(c).to_numpy() for c in ("key", "c1", "c2", "own", "u", "n", "label")]
                now.append(batch.column("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH))
                now = now if carry is None else [np.concatenate(x) for x in zip(carry, now)]
            elif carry is None:
                return
            else:
                now = carry
            key, c1, c2, own, u, n, label, bits = now
            edge = np.flatnonzero((key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])) + 1
            starts, stops = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
            keep = len(key)
            if batch is not None:  # the last run may go on
                keep = starts[-1]
                starts, stops = starts[:-1], stops[:-1]
            carry = [x[keep:] for x in now] if batch is not None else None
            p = starts[stops - starts == 2]
            near = (label[p] != label[p + 1]) & ((c1[p] == c2[p]) | (own[p] != own[p + 1])) & _may_be(n[p], n[p + 1], bits[p] ^ bits[p + 1], similarity)
            two = np.unique(np.stack([np.maximum(u[p], u[p + 1])[near], np.minimum(u[p], u[p + 1])[near]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(two[:, 0], pa.int64()), pa.array(two[:, 1], pa.int64())], names=["a", "b"])
            longer = stops - starts > 2
            for s, e in zip(starts[longer].tolist(), stops[longer].tolist()):
                got = []
                for i in range(s, e - 1):
                    r = slice(i + 1, e)
                    near = label[r] != label[i]
                    if c1[s] != c2[s]:
                        near &= own[r] != own[i]
                    j = np.flatnonzero(near) + i + 1
                    if len(j):
                        j = j[_may_be(n[j], n[i], bits[j] ^ bits[i], similarity)]
                        got.append(np.stack([np.maximum(u[j], u[i]), np.minimum(u[j], u[i])], axis=1))
                    if sum(map(len, got)) > 1 << 16 or (i == e - 2 and got):
                        two = np.concatenate(got)
                        got = []
                        yield pa.RecordBatch.from_arrays([pa.array(two[:, 0], pa.int64()), pa.array(two[:, 1], pa.int64())], names=["a", "b"])

    return rows.repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2").mapInArrow(lean(run), "a long, b long")


def may_be_similar(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct links (a, b), b the smaller, whose sizes and fine sketches allow the similarity.

    Of two lengths the longer sketch is folded; similar sets' lengths are at most a factor of two apart."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    side = lambda x: sets.select(F.col("u").alias(x), F.struct("n", "fine").alias(f"s{x}"))
    both = edges.join(side("a"), "a").join(side("b"), "b")
    half = lambda f: F.floor(F.size(f) / 2).cast("int")
    xor = lambda x, y: F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q))
    folded = lambda f, g: F.when(F.size(f) > F.size(g), xor(F.slice(f, F.lit(1), half(f)), F.slice(f, half(f) + 1, half(f)))).otherwise(F.col(f))
    differ = F.aggregate(xor(folded("sa.fine", "sb.fine"), folded("sb.fine", "sa.fine")), F.lit(0), lambda acc, x: acc + F.bit_count(x))
    sizes = F.least("sa.n", "sb.n") >= similarity * F.greatest("sa.n", "sb.n") - 1e-9
    return both.filter(sizes).filter(differ <= (1 - similarity) / (1 + similarity) * (F.col("sa.n") + F.col("sb.n")) + 1e-9).select("a", "b")


def verified(edges: DataFrame, sets: DataFrame, docs: DataFrame, size: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The links (a, b) whose texts have the Jaccard similarity or more on sets of `size`-word shingles.

    A bucket is a smaller end b, or a part of its links where it has more than BUCKET; each text goes once to each of its
    buckets. sets: (u, id, fp), by which texts are looked up in docs.
    """
    import pyarrow as pa

    spark = edges.sparkSession
    edges = written(edges, "edges")
    many = edges.groupBy("b").count().filter(F.col("count") > BUCKET).select("b", F.ceil(F.col("count") / BUCKET).cast("int").alias("parts"))
    dealt = edges.join(many, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
    members = dealt.select("b", "part", F.explode(F.array("a", "b")).alias("u")).distinct()
    members = written(members.join(sets.select("u", F.col("id").alias("__id"), F.col("fp").alias("__fp")), "u"), "members")
    few = members.count() <= BROADCAST_ROWS
    wanted = members.select("__id").distinct()
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if few:  # at most BROADCAST_ROWS rows of two numbers and a digest; beyond that the texts are shuffled instead
        texts = texts.join(F.broadcast(wanted), "__id", "left_semi")

    def digest(parts):
        import numpy as np
        import xxhash

        for batch in parts:
            fps = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(xxhash.xxh3_128_digest(shingle_set(t.as_py(), size).tobytes()), "<i8") for t in batch.column("text"))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(fps) + 1, 2, dtype=np.int32)), pa.array(fps))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), lists, batch.column("text")], names=["__id", "__fp", "text"])

    kind = dict(members.dtypes)["__id"]
    read = texts.mapInArrow(lean(digest), f"__id {kind}, __fp array<bigint>, text string")
    placed = read.join(F.broadcast(members) if few else members, ["__id", "__fp"]).select("b", "part", "u", "text")
    rows = placed.withColumn("a", F.lit(None).cast("long")).unionByName(dealt.select("b", "part", F.col("b").alias("u"), F.lit(None).cast("string").alias("text"), "a"))
    spread = rows.repartition("b", "part").sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())

    def run(parts):
        now, sets_here = None, {}
        for batch in parts:
            got_a, got_b = [], []
            for b, part, u, text, a in zip(*(batch.column(c).to_pylist() for c in ("b", "part", "u", "text", "a"))):
                if (b, part) != now:
                    now, sets_here = (b, part), {}
                if a is None:
                    if u not in sets_here:
                        sets_here[u] = shingle_set(text, size)
                elif similar(sets_here[a], sets_here[b], similarity):
                    got_a.append(a)
                    got_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(got_a, pa.int64()), pa.array(got_b, pa.int64())], names=["a", "b"])

    with arrow_rows(spark, 50):  # rows with whole texts
        return written(spread.mapInArrow(lean(run), "a long, b long"), "verified")


def similar(s, t, similarity: float) -> bool:
    import numpy as np

    both = len(np.intersect1d(s, t, assume_unique=True))
    return both >= similarity * (len(s) + len(t) - both)


def labelled(sets: DataFrame, links: DataFrame) -> DataFrame:
    """sets with the smallest u that links reach."""
    roots = components(links).select(F.col("node").alias("u"), F.col("root").alias("label"))
    return sets.drop("label").join(roots, "u", "left").withColumn("label", F.coalesce("label", "u"))


def similar_sets(sets: DataFrame, docs: DataFrame, n_docs: int, size: int, similarity: float, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) that connect the distinct sets (u, id, fp, sign, n, sketch, fine) as all pairs of this similarity would.

    First, SimHash: fingerprints within max_bits meet by pigeonhole masks. The pairs that fingerprints miss share a shingle
    of both prefixes: rows of a shared shingle are linked to two of them. Both kinds of links are checked on the texts, and
    join most of each class. Then every pair of two classes in a shared shingle is looked at, shingles of over RUN rows
    dealt out as pairs of parts.
    """
    check = lambda edges: verified(may_be_similar(edges, sets, similarity), sets, docs, size, similarity, id_col, text_col)
    signs = sets.groupBy("sign").agg(F.min("u").alias("node"))
    equal = sets.select("sign", "u").join(signs, "sign").filter("u <> node").select(F.col("u").alias("a"), F.col("node").alias("b"))
    hashed = links_within(written(signs.select("node", F.array("sign").alias("fp")), "signs"), max_bits)

    keys = written(shared_prefixes(docs, n_docs, size, similarity, id_col, text_col), "keys")
    rows = written(keys.join(sets.select(F.col("fp")[0].alias("name"), "u"), "name").select("key", "u"), "shared")
    hubs = sets.select("u", "n", "sketch").join(rows.groupBy("u").agg(F.count("*").alias("hub")), "u")
    links = check(equal.unionByName(hashed).unionByName(_stars(rows.join(hubs, "u"), similarity)))

    own = written(labelled(sets, links).select("u", "n", "label", "sketch"), "labelled")
    mixed = written(_mixed(rows.join(own.select("u", "label"), "u").select("key", "u", "label")), "mixed")
    parts = mixed.groupBy("key").count().filter(F.col("count") > RUN).select("key", F.ceil(F.col("count") / RUN).cast("int").alias("parts"))
    dealt = mixed.join(parts, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int")).join(own, "u")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = _pairs(dealt.select("key", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "own", "u", "n", "label", "sketch"), similarity)
    return links.unionByName(check(pairs))


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those whose class (links at `similarity` or more) holds a smaller id; rows of one id stay together.

    Similarity is the Jaccard similarity of sets of `size`-word shingles, for all pairs: SimHash finds most, an exact join
    the rest. Rows with a null id always stay. Null texts and texts without words are copies of one another.
    """
    with arrow_rows(docs.sparkSession, 100):  # rows with whole texts
        rows = written(set_rows(docs, size, id_col, text_col), "rows")
        by_set = rows.filter("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("id"), *(F.any_value(c).alias(c) for c in ("sign", "n", "sketch", "fine")))
        sets = written(by_set.withColumn("u", F.monotonically_increasing_id()), "sets")
        links = similar_sets(sets, docs, rows.count(), size, similarity, max_bits, id_col, text_col)
        least = sets.join(components(links).select(F.col("node").alias("u"), F.col("root").alias("label")), "u", "left").withColumn("label", F.coalesce("label", "u"))
        roots = least.groupBy("label").agg(F.min("id").alias("component"))
        named = least.select("fp", "label").join(roots, "label").select("fp", "component")
        gone = rows.filter("id IS NOT NULL").select("id", "fp").join(named, "fp").filter("id <> component")
        gone = written(gone.select(F.col("id").alias(id_col)).distinct(), "gone")
    return docs.join(gone, id_col, "left_anti").select(docs.columns)
