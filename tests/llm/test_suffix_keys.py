import zlib

import numpy as np
import pyarrow as pa

from townlens.llm import suffix_dedup as s
from townlens.llm.common import written as kept


def test_the_first_pass_sends_few_bytes_a_key():
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(97, 123, 200_000))) for _ in range(2)]
    rows = pa.table({"block": pa.array([3, 3]), "doc_id": pa.array([1, 2]), "text": pa.array(texts)})
    got = s.keys_of_block(50, 1, s.SLICE)(rows).to_pylist()
    raw = b"".join(r["a"] + r["b"] for r in got)
    assert len(zlib.compress(raw, 1)) / sum(len(r["a"]) // 8 for r in got) < 4.5


def test_keys_alike_in_what_is_told_are_asked_for_by_both_blocks():
    one, two = np.array([5 << 24 | 1], np.uint64), np.array([5 << 24 | 2], np.uint64)
    told = [x >> s.UNTOLD for x in (one, two)]
    rows = [(0, b, s.gaps(k), s.planes(np.array([2], np.uint32))) for b, k in enumerate(told)]
    wanted = s.keys_of_several(100)(s.sent(rows)).to_pylist()
    assert [r["block"] for r in wanted] == [0, 1] and all(s.held(told[0], s.ungaps(r["a"])).all() for r in wanted)


def test_pieces_are_written_into_no_table(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(s, "written", lambda df, tag, **more: tables.append(kept(df, tag, **more)) or tables[-1])
    monkeypatch.setattr(s, "forget", lambda df: None)
    line = "one line of more than fifty bytes that two of the documents hold alike. "
    df = spark.createDataFrame([(1, line + "a" * 60), (2, "b" * 60 + line), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in s.remove_repeats(df).collect()}
    assert got == {1: 0, 2: len(line), 3: 0}  # repeats within one document stay
    assert all(df.filter("bucket >= 0").isEmpty() for df in tables if "bucket" in df.columns)
