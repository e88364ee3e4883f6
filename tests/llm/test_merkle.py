import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from townlens.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(hashes):
    """Root, and for each position the siblings with their side."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, p in enumerate(at):
            paths[i].append((p % 2 == 1, level[p ^ 1] if p ^ 1 < len(level) else None))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], paths


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, h(*map(field, r))))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    climbed = {}
    for k in order:
        trees[k].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        climbed[k] = climb([x[1] for x in trees[k]])
    root, over = climb([climbed[k][0] for k in order]) if order else (None, [])
    out = []
    for k, more in zip(order, over):
        for (r, leaf), own in zip(trees[k], climbed[k][1]):
            path = own + more
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = h(*map(field, (*r[:3], r[3] + 1, r[4]))) if hit and r[3] is not None else leaf
            for right, other in path:
                now = h(other or "", now) if right else h(now, other or "")
            out.append((r[0], leaf, climbed[k][0], root, h(*[o for _, o in path if o]), now, now == root))
    return sorted(out, key=repr)


def rows(n, langs, seed=3):
    rng = random.Random(seed)
    return [(i, rng.choice(["web", None, ""]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "é" * i, "x:1"])) for i in rng.sample(range(10 * n), n)]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("n, langs, band", [(1, ["en"], 8), (2, ["en", None], 8), (300, ["en", "de", None, "", "é", "fr", "pt", "it"], 2), (257, ["en"], 3), (700, ["en"], 8), (64, ["a", "b"], 1)])
def test_equals_brute_force(spark, monkeypatch, n, langs, band):
    monkeypatch.setattr(merkle.manifest, "__defaults__", tuple(band if x == merkle.BAND and isinstance(x, int) else x for x in merkle.manifest.__defaults__))
    some = rows(n, langs)
    df = spark.createDataFrame(some, SCHEMA).repartition(5).withColumns({"at": F.lit(1), "tree": F.lit("x"), "leaf": F.lit(2)})
    assert sorted([tuple(r) for r in merkle.tamper_report(df).collect()], key=repr) == brute(some)


def test_nulls_repeated_rows_and_empty_table(spark):
    some = [(None, None, None, None, None)] * 3 + [(7, "a", "en", 1, "t")] * 4 + [(7, "b", "en", 1, "t"), (8, "-", "en", 0, "-"), (8, "1:a", "en", 0, None)]
    got = merkle.tamper_report(spark.createDataFrame(some, SCHEMA)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(some)
    assert merkle.tamper_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_fields_that_look_alike_differ(spark):
    df = spark.createDataFrame([("a", "1:b"), ("a1:b", ""), (None, "-"), ("-", None), ("-", "-")], "x string, y string")
    assert df.select(merkle.leaf(df["x"], df["y"]).alias("h")).distinct().count() == 5


def test_tampering_is_found_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = merkle.tamper_report(docs).collect()
    assert {r["doc_id"] for r in got if not r["verified"]} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}
    want = brute([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert sorted([tuple(r) for r in got], key=repr) == want
