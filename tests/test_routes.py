import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from townlens.functions import urls
from townlens.operators import nearest, routes


def test_references_resolve_as_the_standard_library_does(spark):
    bases = ["https://t.example.org", "https://t.example.org/", "http://T.example.org/a/b/c.php?x=1#f", "https://t.example.org/a/b/", "https://t.example.org/a//b/../c", "ftp://f.example.org/x", ""]
    refs = ["", "x", "./x", "../x", "../../../../x", "/x/../y", "/x//y", "//other.example.org/z", "//other.example.org", "?q=1", "#top", "x?y#z", ".", "..", "./", "../", "a/./b/../c", "/a/.", "/a/..", "mailto:a@b.c", "HTTPS://o.example.org/./a", "http:y", "https:y", "javascript:void(0)", " /sp ace ", "a//b", "/", "x/", "\t/tab", "é/ü?ñ"]
    rng = random.Random(4)
    refs += ["/".join(rng.choices(["a", "b", ".", "..", ""], k=rng.randint(1, 6))) for _ in range(200)]
    rows = [(b, r) for b in bases for r in refs]
    got = spark.createDataFrame(rows, "b string, r string").select("b", "r", urls.resolve("b", "r").alias("x")).collect()
    wrong = [(g["b"], g["r"], g["x"], urljoin(g["b"].strip(), g["r"].strip())) for g in got if g["x"] != urljoin(g["b"].strip(), g["r"].strip())]
    assert wrong == []
    nulls = spark.createDataFrame([(None, "/x"), ("http://a.b/c", None), (None, None)], "b string, r string").select(urls.normalize("r", "b").alias("x")).collect()
    assert [r["x"] for r in nulls] == [None, "http://a.b/c", None]


def test_every_link_of_the_pages_resolves(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = routes.anchors(pages).select("base", "href", urls.resolve("base", "href").alias("x")).collect()
    assert len(rows) > 100 and all(r["x"] == urljoin(r["base"], r["href"]) for r in rows)


PAGE = """<ul><li><a class="x" href="../staff_directory.php">Staff <b>Directory</b></a><a href='/departments/finance/'>Money &amp; more</a>
<a href=contact_us>Contact</a><a href="/departments/finance/#top">again</a><a href="mailto:a@b.c">staff mail</a><a name="n">none</a>
<A HREF="https://o.example.org/tax?a=1&amp;b=2">Tax Collector</A><a href="/news">News</a></ul>"""


def test_links_are_labelled_classed_and_ordered(spark):
    pages = spark.createDataFrame([(1, "https://T.example.org/a/b/", PAGE), (2, None, None), (3, "https://t.example.org", "")], "page_id long, url string, html string")
    found = [(r["href"], r["label"], r["url"]) for r in routes.anchors(pages).orderBy("place").collect()]
    assert found[0] == ("../staff_directory.php", "Staff Directory", "https://t.example.org/a/staff_directory.php")
    assert found[1][1] == "Money & more" and found[4][2] is None and len(found) == 7
    assert found[5] == ("https://o.example.org/tax?a=1&b=2", "Tax Collector", "https://o.example.org/tax?a=1&b=2")
    best = [(r["url"].rsplit("/", 2)[-2:], r["page_class"], r["score"]) for r in routes.department_links(pages).orderBy("rank").collect()]
    assert best == [(["finance", ""], "department_page", 85 + 12 + 10 + 8), (["o.example.org", "tax?a=1&b=2"], "department_page", 85 + 12 + 10 + 8)]
    staff = [(r["source_kind"], r["page_class"], r["score"]) for r in routes.profile_links(pages).orderBy("rank").collect()]
    assert staff == [("staff_directory_php", "staff_directory", 120 + 5 + 6), ("unknown", "department_page", 85 + 5 + 10), ("contact_hub_path", "contact_hub", 45 + 5)]
    assert routes.profile_links(pages, most=1).count() == 1


def brute(lines, anchor, name):
    at = anchor if name is None else name
    return min(((10 * abs(p - at) + abs(p - anchor), p, t) for p, t in lines if t is not None), default=(0, None, None))[1:]


def test_nearest_titles_equal_brute_force(spark):
    rng = random.Random(5)
    lines, asks = [], []
    for d in range(60):
        n = rng.randint(1, 40)
        lines += [(d, p, rng.choice([None, None, f"t{p}"])) for p in range(n)]
        asks += [(d, rng.randrange(n), rng.choice([None, rng.randrange(n)])) for _ in range(rng.randint(0, 5))]
    asks.append((99, 3, 1))
    got = nearest.nearest_titles(spark.createDataFrame(lines, "doc_id long, place long, title string"), spark.createDataFrame(asks, "doc_id long, anchor long, name long"))
    want = [(d, a, n, *brute([(p, t) for x, p, t in lines if x == d], a, n)) for d, a, n in asks]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_nearest_line_of_a_block(spark):
    rows = [(["Town Clerk", "Jane Doe", "x", "Assessor"], "Jane Doe", "x"), (["Clerk", "x", "Jane Doe", "Assessor"], "Jane Doe", "Clerk"), (["x"], None, None), (["Clerk", "y", "Mayor"], None, "y"), ([], "a", "b"), (["Clerk", "Clerk"], "Clerk", None), (None, "a", "b")]
    hints = lambda x: x.rlike("Clerk|Assessor|Mayor")
    got = spark.createDataFrame(rows, "lines array<string>, name string, anchor string").select(nearest.nearest_in("lines", "name", "anchor", hints).alias("t")).collect()
    assert [r["t"] for r in got] == ["Town Clerk", "Assessor", None, "Clerk", None, None, None]


def test_positions_may_be_many_and_far_apart(spark):
    lines = spark.range(0, 20000, 50).select(F.lit(1).cast("long").alias("doc_id"), F.col("id").alias("place"), F.format_string("t%s", "id").alias("title"))
    asks = spark.range(10000).select(F.lit(1).cast("long").alias("doc_id"), (F.col("id") * 2).alias("anchor"), F.lit(None).cast("long").alias("name"))
    far = nearest.nearest_titles(lines, asks).select(F.max(F.abs(F.col("title_at") - F.col("anchor")))).head()[0]
    assert far == 48
