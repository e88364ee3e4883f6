import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from townlens.llm import suffix_dedup


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array_sorts_all_suffixes(symbols):
    t = [*symbols, 0]
    assert suffix_dedup.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def test_suffix_array_of_runs_and_of_several_texts():
    for t in ([5] * 300 + [0], [1, 2] * 150 + [0], [0, 0, 0], [3, 0, 3, 0, 2, 3, 0]):
        assert suffix_dedup.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def brute(rows, width=50):
    """Each row's result from all windows of all rows."""
    least = {}
    for i, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            least[w] = min(least.get(w, float("inf")), float("inf") if i is None else i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if least[raw[p : p + width]] < (float("inf") if i is None else i):
                gone[p : p + width] = b"\1" * width
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()], key=repr)


def rows_with_everything():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(200)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    line, passage = say(9), say(40)
    rows = [(i, say(rng.randint(0, 60))) for i in range(60)]
    rows += [(100 + i, f"{say(8)} {line} {say(8)}") for i in range(40)]  # one line in ever different words
    rows += [(200 + i, say(5) + passage[i : i + 120] + say(5)) for i in range(30)]  # overlapping parts of a passage
    rows += [(300 + i, rows[i % 7][1]) for i in range(20)]  # copies
    near = say(80).split()
    for i in range(20):  # near copies
        near[rng.randrange(80)] = rng.choice(words)
        rows.append((400 + i, " ".join(near)))
    rows += [(500, "x" * 400), (501, "x" * 130), (502, "xy" * 100), (503, "é" * 60), (504, "日本語テキスト" * 30), (505, "日本語テキスト" * 12), (506, "a" + "é" * 30)]
    rows += [(600, None), (601, ""), (None, passage), (None, passage), (None, None), (602, line + line), (602, line + line), (601, passage), (-5, rows[3][1]), (603, passage[:50]), (604, passage[:49]), (605, passage[1:50] + "!")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block": 700, "hot": 3, "step": 64, "batch": 300}, {"block": 2000, "hot": 12, "step": 100}])
def test_equals_brute_force(spark, sizes):
    rows = rows_with_everything()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "'x' as kept")
    out = suffix_dedup.remove_repeats(docs, **sizes)
    assert found(out) == brute(rows)
    for r in out.collect():
        edges = memoryview(r["spans"]).cast("q").tolist()
        assert len(edges) == 2 * r["n_spans"] and sum(edges[1::2]) - sum(edges[::2]) == r["n_removed"]
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_other_widths_and_empty_table(spark):
    rows = rows_with_everything()[:150]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (26, 73):
        assert found(suffix_dedup.remove_repeats(docs, width=width, keep_text=False)) == brute(rows, width)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, width=20)


def test_shared_windows_are_those_of_equal_bytes():
    rng = random.Random(2)
    core = bytes(rng.choices(range(256), k=90))
    for core in (core, b"ab" * 40, b"abc" * 10 + bytes(range(100, 160))):
        raw = [core, core[20:80] + b"!" * 9, b"?" * 4 + core[:70], core[10:60]]
        at, length, key = suffix_dedup.pieces(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw]), 50)
        texts = sorted({(k, b"".join(raw)[a : a + n + 49]) for a, n, k in zip(at.tolist(), length.tolist(), key.tolist())})
        keys, texts = np.array([k for k, _ in texts], np.uint64), [x for _, x in texts]
        text, window, group = suffix_dedup.shared_windows(texts, keys, 50)
        got = {}
        for t, w, g in zip(text.tolist(), window.tolist(), group.tolist()):
            got.setdefault(g, set()).add((t, w))
        want = {}
        for t, x in enumerate(texts):
            for w in range(len(x) - 49):
                want.setdefault(x[w : w + 50], set()).add((t, w))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_removes_passages_of_the_table_and_leaves_the_first(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(suffix_dedup.remove_repeats(docs, keep_text=False)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
