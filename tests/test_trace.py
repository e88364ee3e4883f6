from pyspark.sql import functions as F

from townlens.operators import trace

SCHEMA = "municipality_id string, name string, title string, department string, email string, phone string, source_url string, why string"


def rows(spark, *names, why="w"):
    return spark.createDataFrame([("t1", n, None, "D", None, "1", "u", why) for n in names], SCHEMA)


def test_rows_are_followed_to_the_stage_that_lost_them(spark):
    stages = {"loaded": rows(spark, "Ann", " ann ", "Bob", "Cid", "Dee", "Eve"), "clean": rows(spark, "Ann", "Cid", "Dee"), "candidates": rows(spark, "ANN", "Cid", "Bob", "New", why=None), "winners": rows(spark, "Ann")}
    found = trace.row_trace(stages, {"loaded": F.concat("why", F.lit("1")), "clean": F.lit("unmapped"), "candidates": F.coalesce("why", F.lit("scored"))})
    got = {r["name"].strip().lower(): (r["rows"], r["stages"], r["drop_stage"], r["drop_reason"]) for r in found.collect()}
    assert got["ann"] == ({"loaded": 2, "clean": 1, "candidates": 1, "winners": 1}, ["loaded", "clean", "candidates", "winners"], None, None)
    assert got["bob"][1:] == (["loaded", "candidates"], "clean", "w1") and got["eve"][2:] == ("clean", "w1")
    assert got["dee"][2:] == ("candidates", "unmapped") and got["cid"][2:] == ("winners", "scored") and got["new"][2:] == ("loaded", "not_loaded")
    losses = {(r["drop_stage"], r["drop_reason"]): r["rows"] for r in trace.trace_losses(found).collect()}
    assert losses == {("clean", "w1"): 2, ("candidates", "unmapped"): 1, ("winners", "scored"): 1}
    assert trace.row_trace({k: v.limit(0) for k, v in stages.items()}, {}).count() == 0


def test_fingerprints_see_words_only(spark):
    df = spark.createDataFrame([("t", "A  b", None, "", "X@y.z", "1", None, ""), ("T ", " a B ", "", None, "x@Y.z ", " 1", "", ""), ("t", "Ab", None, "", "X@y.z", "1", None, "")], SCHEMA)
    a, b, other = [r["f"] for r in df.select(trace.fingerprint().alias("f")).collect()]
    assert a == b != other and len(a) == len("rtrace_") + 18


def test_shares_and_observed_counters_agree(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("page"), F.when(F.col("id") % 7 != 3, F.col("id") % 3 == 0).alias("kept"))
    seen, observation = trace.observed(df, "pages")
    ratios = {r["page"]: r for r in trace.kept_ratios(seen, ["page"]).collect()}
    assert observation.get == {"seen": 1000, "kept": sum(r["kept"] for r in ratios.values())}
    assert {p for p, r in ratios.items() if r["alarm"]} == {3} and ratios[3]["kept"] == 0
    assert not any(r["alarm"] for r in trace.kept_ratios(df, ["page"], fewest=200).collect())
