import random
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest

from townlens.llm import token_counts, token_output
from townlens.llm.vocab import ByteIds, tokenizer

ODD = ["", " ", "\n\n", "a" * 30_000, "x " * 20_000, "It's we'll 'tis ''s !'s", "<|endoftext|> a<|endoftext|>b <|startoftext|>", "É İstanbul ß ﬁ é 日本語 한국 🙂‍🙂", "a\x1cb !\x1c! \x85\xa0 z", "12345 6.7e8 １２", "́x  \t\r\n end  "]
TEXTS = ODD + ["".join(random.Random(i).choices("ab 'stre!?.\n\t\x1c\x85\xa0éİΣ1²٣　́日<|>", k=80)) for i in range(300)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(len(TEXTS), None, None), (5, TEXTS[5], "again"), (None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts_equal_the_library(docs):
    library = tokenizer("word_bpe_49k.json")
    rows = {r["doc_id"]: r for r in token_counts.token_counts(docs, limit=20).collect() if r["doc_id"] is not None}
    assert len(rows) == len(TEXTS) + 1
    for i, t in enumerate([*TEXTS, ""]):
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (rows[i]["n_tokens"], rows[i]["n_bytes"], rows[i]["over_limit"]) == (n, len(t.encode()), n > 20), repr(t)


def test_every_prefix_and_budget(spark):
    library = tokenizer("word_bpe_49k.json")
    texts = TEXTS[5:9] + TEXTS[11:60] + ["", "word " * 60 + "x" * 300, "  two  spaces\n", "z" * 700 + " tail", "é🙂" * 150]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables = token_counts.prefix_tables(df).collect()
    assert [r["doc_id"] for r in tables] == list(range(len(texts)))
    for t, r in zip(texts, tables):
        truth = [len(library.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)]
        counts = token_counts.counts_of(r["changes"])
        inside = {k for m in token_counts.PIECE.finditer(t) if len(m[0]) > token_counts.LONG for k in range(m.start() + 1, m.end())}
        truth = [-1 if k in inside else n for k, n in enumerate(truth)]
        assert counts.tolist() == truth, repr(t)
        for budget in (0, 1, 5, 20):
            assert token_counts.longest_within(counts, budget) == max(k for k, n in enumerate(truth) if 0 <= n <= budget)


def test_answers_from_stored_tables(spark, docs, monkeypatch):
    stored = token_counts.written(token_counts.prefix_tables(docs), "test-tables")
    monkeypatch.setattr(token_counts, "tokenizer", None)  # no tokenizer, no text
    rows = [r for r in token_counts.answers(stored, 20, chars=30).collect() if r["doc_id"] is not None]
    library = tokenizer("word_bpe_49k.json")
    for r in rows:
        t = ([*TEXTS, ""])[r["doc_id"]]
        assert r["prefix_tokens"] == (None if t[:1] == "a" and len(t) == 30_000 else len(library.encode(t[:30], add_special_tokens=False).ids)), repr(t)
        assert len(library.encode(t[: r["fit_chars"]], add_special_tokens=False).ids) <= 20
    assert len(rows) == docs.count() - 1


def test_ids_equal_the_library():
    library = tokenizer("byte_bpe_50k.json")
    got = ByteIds("byte_bpe_50k.json")(TEXTS)
    for t, ids in zip(TEXTS, got):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("high", [1, 2, 300, 50_257, 2**32])
def test_segment_round_trip(high):
    rng = np.random.default_rng(high)
    for n in (0, 1, 1023, 1024, 1025, 5000):
        ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        if n > 100:
            ids[::97] = 2**32 - 1
        lengths = np.array([n // 2, 0, n - n // 2])
        back, parts = token_output.decode_segment(token_output.encode_segment(ids, lengths))
        assert (back == ids).all() and (parts == lengths).all()


def test_output_digest(docs):
    library, at = tokenizer("byte_bpe_50k.json"), 0
    rows = sorted(token_output.token_output(docs.filter("doc_id is not null")).collect(), key=lambda r: (r["doc_id"], r["start"]))
    want = sorted([*enumerate(TEXTS), (len(TEXTS), ""), (5, TEXTS[5])])
    assert len(rows) == len(want)
    for r, (i, t) in zip(rows, want):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), crc)
        at += len(ids)


def test_files_of_the_format(spark, docs, tmp_path, monkeypatch):
    """Any reader can take the files apart, and rows that share an id or have none are spread over parts."""
    monkeypatch.setattr(token_output, "FILE_SEGMENTS", 2)
    many = docs.unionByName(docs.limit(1).selectExpr("cast(null as long) doc_id", "explode(sequence(1, 400)) n").selectExpr("doc_id", "concat('same id ', n) text", "null n_tokens"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = token_output.write_token_file(many, f"file://{tmp_path}/out", segment_ids=500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    library, texts, found, parts = tokenizer("byte_bpe_50k.json"), Counter(), 0, Counter()
    for r in many.collect():
        texts[(r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids) + (2,))] += 1
    for f in (tmp_path / "out" / "segments").glob("part-*"):
        data = f.read_bytes()
        for at, h in token_output.headers(data):
            assert data[at + h[-1]] == 10
            ids, lengths, keys = token_output.decode_whole(data[at : at + h[-1]])
            for k, n, e in zip(keys, lengths, np.cumsum(lengths)):
                texts[(k, tuple(ids[e - n : e].tolist()))] -= 1
                parts[h[7]] += k is None
            found += len(keys)
    assert found == many.count() and not any(texts.values())
    assert sum(n > 0 for n in parts.values()) > 1
    rows = sorted(token_output.read_token_file(spark, path).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in rows] == list(accumulate((r["n_tokens"] for r in rows[:-1]), initial=0))
    named = [r["doc_id"] for r in rows]
    assert named == sorted(named, key=lambda k: (k is not None, k or 0))


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "two"), ("a", "one"), (None, "none"), ("é", "")], "doc_id string, text string")
    assert [r["doc_id"] for r in sorted(token_output.token_output(df).collect(), key=lambda r: r["start"])] == [None, "a", "b", "é"]


def test_empty(spark, docs):
    none = docs.limit(0)
    assert token_counts.token_counts(none).count() == 0
    assert token_output.token_output(none).count() == 0
