from pathlib import Path

from townlens.llm import token_output


def test_a_file_is_a_small_value(spark, tmp_path):
    """A file is read as one value, of which several copies stand in memory: no file may hold many segments."""
    docs = spark.range(1000).selectExpr("id doc_id", "repeat(concat('word', id, ' '), 30) text").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    path = token_output.write_token_file(docs, f"file://{tmp_path}/out", segment_ids=1000)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = [f.read_bytes() for f in (Path(tmp_path) / "out" / "segments").glob("part-*")]
    held = [len(token_output.headers(x)) for x in files]
    assert sum(held) > 64 and max(held) * token_output.SEGMENT_IDS * 4 <= 8 << 20
    rows = token_output.read_token_file(spark, path).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == list(range(1000))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
