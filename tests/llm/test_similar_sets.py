"""Near-duplicates of the pipeline against all pairs."""

import random

import pytest

from bylinelake.llm import simhash


def all_pairs(texts, similarity=0.8):
    sets = [set(simhash.shingle_hashes(t or "", 5).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in range(len(texts)) if find(i) == i}


def kept(docs, texts):
    return {r["doc_id"] for r in simhash.drop_near_duplicates(docs(texts).repartition(3)).collect()}


def template(n):
    """Pairs of near copies (126 of 154 shingles shared) on one template: strangers share 120 of 160."""
    shared, out = [f"t{i}" for i in range(124)], []
    for f in range(n):
        own = [[f"{side}{f}x{i}" for i in range(20)] for side in "ab"]
        out += [" ".join(shared + own[0]), " ".join(shared + own[0][:6] + own[1][6:])]
    random.Random(1).shuffle(out)
    return out


@pytest.mark.parametrize("run", [4096, 4])
def test_long_runs_lose_no_pair(spark, docs, monkeypatch, run):
    """Closer strangers and rows far apart in a run do not hide a pair."""
    monkeypatch.setattr(simhash, "RUN", run)
    texts = template(40)
    rng, base = random.Random(2), [f"c{i}" for i in range(60)]
    for _ in range(30):  # a dense cluster
        copy = list(base)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(60)] = f"d{rng.randrange(9)}"
        texts.append(" ".join(copy))
    assert kept(docs, texts) == all_pairs(texts)


def test_equal_majorities_are_not_copies(spark, docs):
    """A run of one repeated word outvotes all other shingles of a fingerprint; sets tell the texts apart."""
    rng, run = random.Random(3), " ".join(["same"] * 64)
    texts = [" ".join(f"e{i}x{rng.randrange(10**6)}" for _ in range(120)) + " " + run for i in range(6)]
    plain = " ".join(f"p{i}" for i in range(400))
    texts += [plain, plain + " " + " ".join(["==="] * 400)]
    assert kept(docs, texts) == all_pairs(texts) == {0, 1, 2, 3, 4, 5, 6}


def test_least_similar_and_short_pairs_are_found(spark, docs):
    """Short texts of 4 in 5, 5 in 6 and 6 in 7 shared shingles, and longer ones at 0.8 to 0.84."""
    rng, texts = random.Random(4), []
    for i in range(60):
        base = [f"s{i}x{j}" for j in range(9 + i % 3)]
        texts += [" ".join(base), " ".join(base[:-1])]
    for i in range(40):
        base = [f"l{i}x{j}" for j in range(rng.randrange(60, 300))]
        at = rng.randrange(5, len(base))
        texts += [" ".join(base), " ".join(base[: at - (len(base) - 4) // 6] + base[at:])]
    want = all_pairs(texts)
    assert len(want) < 140
    assert kept(docs, texts) == want
