import time

import pytest
from pyspark.sql import functions as F

from townlens.functions import people
from townlens.operators import fragments


def value(spark, column):
    return spark.range(1).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize("text, want, joins", [
    ("call 20 3-555-0142 x 12 now", "call 203-555-0142x 12 now", 2), ("203-555-0142 x 12", "203-555-0142x 12", 1), ("203 555 0142", "203-555-0142", 1),
    ("203-555-0142 203-555-0142 203-555-0142", "203-555-0142", 1), ("a  b", "a b", 0), ("", "", 0), (None, "", 0), ("20 35550142", "2035550142", 1), ("12 Main 555", "12 Main 555", 0),
])
def test_split_digits_are_joined_and_counted(spark, text, want, joins):
    got = spark.createDataFrame([(text,)], "t string").select(people.joined_digits("t").alias("t"), people.joins_of("t").alias("n")).head()
    assert (got["t"], got["n"]) == (want, joins)


def test_who_reads_as_a_person(spark):
    yes = ["Jane Doe", "Mary-Ann O'Neil", "Jo R. Doe", "Ann de la Cruz", "Robert Poe, Jr.", "Carl Dow III"]
    no = ["", None, "Jane", "JANE DOE", "Jane Doe 2", "Town Clerk", "Finance Office", "Quick Links", "Main Street", "Elm Court", "Vacant Position", "Click Here", "Deputy Chief", "First Floor", "Fire Academy", "Jane doe", "New London Point"]
    rows = spark.createDataFrame([(x,) for x in yes + no], "x string").select("x", people.is_person("x").alias("y")).collect()
    assert {r["x"] for r in rows if r["y"]} == set(yes)


def test_labels_of_departments(spark):
    cases = {"Assessor's Office": "Assessor's", "building_department": "Building", "Finance Department": None, "Town of Avon | Tax": None, "Land Use": "Land Use", "Bids and RFPs": None, "Departments": None, "Contact Info": None, None: None, "Tax & Revenue": "Tax & Revenue"}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", people.department_label("x").alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == cases


def test_a_phone_after_fax_comes_last(spark):
    cases = {"Fax: 203-555-0001 or 203-555-0002 x7": ("2035550002", "7"), "fax 203-555-0001": ("2035550001", "5"), "tel 1 (860) 555-0003 ext. 123": ("8605550003", "123"), "none": (None, "5"), "Fax number here is far away from 203-555-0004": ("2035550004", "5")}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    phone, extension = fragments.phone_and_extension(F.col("t"), F.lit("5"))
    assert {r["t"]: (r["p"], r["e"]) for r in df.select("t", phone.alias("p"), extension.alias("e")).collect()} == cases


PAGE = """<html><head><title>Welcome</title></head><body>
<div class="x" id="y"><nav class="breadcrumb" id="breadcrumbs">Home > Departments > Land Use</nav></div>
<aside id="staff-dr"><div class="staff"><h4>Jane Doe <span>Town Clerk</span></h4><a href="mailto:jd@t.example.org">mail</a><a href="tel:2035550100">call</a></div></aside>
<div class="contact-card"><b>20</b> <i>3-555-0142</i> x 12 <h4>Ann Bell</h4> Assistant to all</div>
<div class="staff"><h3>Vacant</h3>203-555-0143</div>
<div class="staff"><p>office 203 555 0144</p></div>
<li class="employee"><h2>Madonna</h2>room 5</li>
<li class="employee"><h2>Prince</h2><p>Chief of staff</p> 2035550145</li>
<section class="profile"><h2>Carl Dow</h2>room 7</section>
<div class="staff">nothing here</div><div class="news">203-555-0199</div>
<div class="contact">Office Hours 203-555-0146</div><footer><div class="staff">203-555-0147</div></footer>
</body></html>"""


@pytest.fixture(scope="module")
def rebuilt(spark):
    pages = spark.createDataFrame([(1, "https://t.example.org/x", PAGE), (2, None, None), (3, "https://t.example.org/", "")], "page_id long, url string, html string")
    return fragments.reconstruct(fragments.staff_blocks(pages.withColumn("lines", F.lit(1))))


def test_blocks_are_put_together_or_rejected_with_a_reason(rebuilt):
    rows = rebuilt.orderBy("block_no").collect()
    got = [(r["name"], r["title"], r["phone"], r["phone_ext"], r["joins"], r["rejection_reason"]) for r in rows]
    assert got == [
        ("Jane Doe", "Town Clerk", "2035550100", None, 0, "already_structured_sidebar"),
        ("Ann Bell", "Assistant to all", "2035550142", "12", 2, None),
        ("Vacant", None, "2035550143", None, 0, "vacancy_name"),
        (None, None, "2035550144", None, 1, "missing_name"),
        ("Madonna", None, None, None, 0, "invalid_person_name"),
        ("Prince", "Chief of staff", "2035550145", None, 0, None),
        ("Carl Dow", None, None, None, 0, "missing_supporting_signal"),
    ]
    assert {r["department"] for r in rows} == {"Land Use"}


def test_accepted_blocks_are_contacts_and_reasons_add_up(spark, rebuilt):
    pages = spark.createDataFrame([(1, "https://t.example.org/x", PAGE)], "page_id long, url string, html string")
    rows = fragments.reconstructed_contacts(pages).collect()
    accepted = rebuilt.filter("accepted").count()
    assert len(rows) == accepted and {(r["source_kind"], r["confidence"]) for r in rows} == {("reconstructed_contact_block", 0.86)}
    counts = {r["reason"]: r["blocks"] for r in fragments.rejection_counts(rebuilt).collect()}
    assert counts.pop("accepted") == accepted and set(counts) == {"already_structured_sidebar", "vacancy_name", "missing_name", "invalid_person_name", "missing_supporting_signal"}


def test_departments_come_from_six_sources_in_order(spark):
    none = []
    rows = [
        (["Home", "Departments", "Land Use", "Staff"], "Assessor", "x", none, none, None, "Land Use"), (["Home", "Zoning"], "Assessor", None, none, none, None, "Zoning"), (["Home"], "Assessor", "Tax", none, none, None, "Assessor"),
        (None, "Town Hall", "Tax", none, none, None, "Tax"), (none, None, None, ["Finance", "Human Resources"], none, None, "Human Resources"), (none, None, None, none, ["Wetlands"], "https://t.example.org/departments/land_use/index.php", "Land Use"),
        (none, None, None, none, ["Wetlands"], "https://t.example.org/departments/index.php", "Wetlands"), (none, None, None, none, none, "https://t.example.org/a/town-clerk/index.php", "Town Clerk"), (None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "crumbs array<string>, h1 string, title string, headings array<string>, nav array<string>, url string, want string")
    got = df.select("want", fragments.inferred_department(*(F.col(c) for c in df.columns[:6])).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_a_long_text_without_a_phone_is_read_once(spark):
    df = spark.createDataFrame([("no phone 12 " * 10_000,), ("fax 203-555-0001 " + "no phone 12 " * 10_000,)], "t string")
    began = time.monotonic()
    rows = df.select(fragments.spoken(F.col("t"), F.lit("5")).alias("s")).select("s.phone", "s.ext").collect()
    assert sorted((r["phone"] or "", r["ext"]) for r in rows) == [("", "5"), ("2035550001", "5")]
    assert time.monotonic() - began < 20


def test_every_block_line_and_label_of_a_page_is_read(spark):
    person = lambda i: f"Jane D{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}"
    nav = '<div id="leftnav">' + "".join(f"<a>Quick links {i}, CT</a>" for i in range(30)) + "<a>Land Use</a></div>"
    blocks = "".join(f'<div class="staff"><h4>{person(i)}</h4>room 203-555-01{i:02}</div>' for i in range(90))
    late = '<div class="contact">' + "".join(f"<i>room {i}</i>" for i in range(30)) + "<b>Ann Bell</b><b>203-555-0199</b></div>"
    pages = spark.createDataFrame([(1, None, nav + blocks), (2, None, late)], "page_id long, url string, html string")
    rows = {(r["page_id"], r["name"]): r for r in fragments.reconstructed_contacts(pages).collect()}
    assert set(rows) == {(1, person(i)) for i in range(90)} | {(2, "Ann Bell")}
    assert {r["department"] for (p, _), r in rows.items() if p == 1} == {"Land Use"} and rows[1, person(89)]["block_no"] == 89
    assert (rows[2, "Ann Bell"]["phone"], rows[1, person(89)]["phone"]) == ("2035550199", "2035550189")


def test_blocks_of_a_page_that_go_in_parts_keep_their_numbers(spark):
    html = "".join(f'<div class="staff"><h4>Ann Bell</h4>room 203-555-{i:04}</div>' for i in range(2345))
    pages = spark.createDataFrame([(k, None, html) for k in (1, 2)] + [(3, None, None)], "page_id long, url string, html string")
    got = fragments.staff_blocks(pages).select("page_id", "block_no", F.get("lines", F.lit(1)).alias("said")).collect()
    assert sorted(tuple(r) for r in got) == [(k, i, f"room 203-555-{i:04}") for k in (1, 2) for i in range(2345)]


def test_one_phone_many_times_in_a_row_is_one(spark):
    rows = spark.createDataFrame([("203-555-0142 " * 50_000,)], "t string").select(people.joined_digits("t").alias("x"), people.joins_of("t").alias("n")).head()
    assert tuple(rows) == ("203-555-0142", 1)
