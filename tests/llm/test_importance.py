import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from townlens.llm import importance


def features(text, run=2):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return words, [" ".join(words[i : i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, run=2, buckets=10_000, share=25, least=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    mine = [(i, *features(t, run)) for i, t in docs]
    s, t = Counter(bucket(f) for _, _, fs in mine for f in fs), Counter(bucket(f) for x in target for f in features(x, run)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for i, words, fs in mine:
        weight = sum(map(gain, map(bucket, fs))) // len(fs) if fs else 0
        u = (int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log(u))), None, len(words)])
    may = sorted([r for r in out if r[5] >= least], key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(may[: share * len(may) // 100]):
        r[4] = k + 1
    return sorted([tuple(r[:5]) for r in out], key=repr)


def found(df):
    return sorted([(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()], key=repr)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["Straße", "É", "a1", "THE", "the", "x" * 300, "日本", "don't", "a_b", "\x00", "²", "İ"] + [f"w{i}" for i in range(30)]
    return [rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.choice([0, 1, 2, 19, 20, 60]))) for _ in range(n)]


def test_a_scan_gives_the_checksums_of_all_runs():
    for run in (1, 2, 4):
        for text in texts(30):
            words, crcs = importance.scan(text.encode(), run)
            own, fs = features(text, run)
            assert words == len(own) and Counter(crcs) == Counter(zlib.crc32(f.encode()) for f in fs)


@pytest.mark.parametrize("how", [{}, {"run": 3, "buckets": 7, "share": 60, "least_words": 2, "seed": 1}, {"buckets": 70_000, "share": 100}])
def test_equals_brute_force(spark, how):
    docs = list(enumerate(texts(150))) + [(None, None), (None, "a b " * 20), (900, ""), (901, None)]
    target = [*texts(10, 9), None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as words", "2 as tree", "3 as rank").repartition(4)
    want = brute(docs, target, **({"least": how["least_words"]} if "least_words" in how else {}), **{k: v for k, v in how.items() if k != "least_words"})
    assert found(importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), **how)) == want


def test_ties_and_repeated_rows_rank_once_each(spark):
    docs = [(5, "one two " * 15)] * 8 + [(6, "one two " * 15)] * 8
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("one",)], "text string"), share=75)
    rows = got.collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 13))
    best = max(rows, key=lambda r: r["score"])["doc_id"]
    assert {r["doc_id"] for r in rows if r["rank"] and r["rank"] <= 8} == {best}


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    assert found(importance.resample(some, none)) == brute([(1, "a b c")], [])
    with pytest.raises(ValueError):
        importance.weigh(some, some, buckets=0)


def test_draws_more_of_what_the_target_is_like(spark):
    rng = np.random.default_rng(0)
    docs = [(i, " ".join(rng.choice([f"{'t' if i % 2 else 'c'}{k}" for k in range(40)], 30))) for i in range(400)]
    target = [(" ".join(f"t{k}" for k in rng.integers(0, 40, 30)),) for _ in range(20)]
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "text string")).collect()
    drawn = [r["doc_id"] for r in got if r["rank"]]
    assert len(drawn) == 100 and sum(i % 2 for i in drawn) > 65


def test_equals_brute_force_on_the_table(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in bench.collect()])
    assert found(importance.resample(docs, bench)) == want
