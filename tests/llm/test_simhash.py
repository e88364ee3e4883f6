import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from townlens.llm import simhash


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [(i, brute_fingerprint(t or "")) for i, t in rows]
    root = {i: i for i, _ in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in combinations(fps, 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i: (f"{f:016x}", find(i)) for i, f in fps}


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    y = x.copy()
    for _ in range(2):
        y ^= np.uint64(1) << rng.integers(0, 64, len(x), dtype=np.uint64)
    (ra, ka), (rb, kb) = simhash.fuzzy_keys(x.view(np.int64), True), simhash.fuzzy_keys(y.view(np.int64), False)
    a, b = [set() for _ in x], [set() for _ in x]
    for r, k in zip(ra.tolist(), ka.tolist()):
        a[r].add(k)
    for r, k in zip(rb.tolist(), kb.tolist()):
        b[r].add(k)
    assert all(p & q for p, q in zip(a, b)) and max(map(len, b)) <= 18


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(3), []
    vocabulary = [f"w{i}" for i in range(400)]
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.choice([5, 60, 400]))
        for _ in range(rng.choice([1, 1, 3, 12])):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append((len(out) * 3 + 1, " ".join(copy)))
    out += [(9000, ""), (9001, None), (9002, " \n\t"), (9003, "one"), (9004, "ONE two"), (9005, "one TWO"), (9006, "É " * 30_000), (9007, "a\x85b\x1cc d")]
    rng.shuffle(out)
    return out


def test_against_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string").repartition(5)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute(rows)
    kept = {r["doc_id"] for r in simhash.keep_one(docs.union(docs)).collect()}
    assert kept == {c for _, c in got.values()} and simhash.keep_one(docs.union(docs)).count() == len(kept)


def test_chain_of_links(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (502, 500)] + [(1000, 1001 + i) for i in range(300)]
    got = {r["node"]: r["component"] for r in simhash.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500, **{1000 + i: 1000 for i in range(301)}}


def test_empty_and_null_ids(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (None, "x y z")], "doc_id long, text string")
    assert sorted(str((r["doc_id"], r["component_id"])) for r in simhash.near_duplicates(odd).collect()) == ["(7, 7)", "(None, 7)", "(None, None)"]
    assert simhash.keep_one(odd).count() == 3


def test_similarity_stage_against_brute_force(spark):
    """Copies with one to six words changed, among them chains and pairs on both sides of 0.8."""
    rng, rows = random.Random(4), []
    for _ in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 40, 120, 400]))]
        for _ in range(rng.choice([1, 2, 4, 30])):
            words = list(words)
            for _ in range(rng.randrange(7)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(9000, ""), (9001, None), (9002, rows[0][1].upper())]
    sets = {i: {tuple((t or "").lower().split()[k : k + 5]) for k in range(max(1, len((t or "").split()) - 4))} for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [(i, j) for i, j in combinations(sets, 2) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    for i, j in links:
        x, y = sorted((find(i), find(j)))
        root[y] = x
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(docs).collect()}
    assert got == {i: find(i) for i in sets}
    bits = {i: simhash.fingerprint(t or "") for i, t in rows}
    assert sum((bits[i] ^ bits[j]).bit_count() > 2 for i, j in links) > 20
    assert {r["doc_id"] for r in simhash.keep_one(docs, shingle=5, similarity=0.8).collect()} == set(got.values())


def test_heavy_fingerprints_are_split_off(spark, monkeypatch):
    rows = [(i, "one text of all") for i in range(300)] + [(1000 + i, None) for i in range(200)] + [(2000 + i, f"text number {i % 7} of some") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    one = sorted(map(tuple, simhash.near_duplicates(df).collect()))
    alike = sorted(map(tuple, simhash.similar_groups(df).collect()))
    for heavy, size in ((100, 16 << 20), (100, 0), (3, 16 << 20)):
        monkeypatch.setattr(simhash, "HEAVY", heavy)
        monkeypatch.setattr(simhash, "HEAVY_BYTES", size)
        assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == one
        assert sorted(map(tuple, simhash.similar_groups(df).collect())) == alike
    assert len(one) == 540 and one[299][2] == 0 and one[300][2] == 1000


def test_similar_groups_against_brute_force(spark):
    """A large group of near copies, a passage that dissimilar documents share, chains, copies and short texts."""
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    base, passage, texts = fresh(120), fresh(90), []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(words)
    texts += [passage + fresh(rng.randint(5, 60)) for _ in range(60)]
    chain = fresh(150)
    for k in range(12):
        texts.append(list(chain))
        at = 12 * k
        chain[at : at + 2] = fresh(2)
    texts += [fresh(rng.randint(1, 7)) for _ in range(20)] + [texts[3], texts[70], [], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [set(simhash.shingle_set(t, 5).tolist()) for _, t in rows]
    low = list(range(len(rows)))

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or (both and both >= 0.8 * len(sets[i] | sets[j])):
            a, b = sorted((top(i), top(j)))
            low[b] = a
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == {i: top(i) for i in range(len(rows))}
    assert len(set(got.values())) > 60 and max(Counter(got.values()).values()) > 25
