import pytest

from townlens.functions.dom import parse
from townlens.operators import staff_pages

HEAD = "<html><head><title>Assessor Department</title></head><body>"
SECTIONS = HEAD + """<h2>Building Office</h2><p>Jane Doe</p><p>Building Inspector</p><p>203-555-0100</p><p>Ann Bell</p><p>Clerk</p><p>Email: ann@t.org</p><p>rest</p>
<div class="team">Carl Dow, Director <a href="mailto:cd@t.org">m</a> 203-555-0102</div><article><h3>Mary Poe</h3> writes to mp@t.org about things</article>
<div id="hours-wrap">Office Hours<p>Robert Roe 203-555-0109</p></div><div>Resources <div>Resources</div><p>Al Roe 203-555-0108</p></div><ul class="a resource-link"><li>x</li></ul>
<script>RZ.module("x")</script><script>var a</script><table><tr><th>Name</th><th>Title</th><th>Phone</th></tr><tr><td>Tom Ray</td><td>Chief</td><td>203-555-0110</td></tr></table>
<footer class="footer-links-box"><p>Zed Zoe 203-555-0111</p><footer>inner</footer></footer></body></html>"""
FIELDS_PAGE = "<h1>Pat Lee</h1><p>Position: Clerk</p><p>Office phone: 203-555-0120 x4</p><p>position: other</p><p>Location - Main Hall</p>"
SAME = HEAD + "<div class='profile'><strong>Jane Doe</strong> 203-555-0130 daily</div><h3>Fire Division</h3><p>Jane Doe</p><p>203-555-0130</p>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "https://t.org/x", SECTIONS), (2, "https://t.org/y", FIELDS_PAGE), (3, None, None), (4, "https://t.org/z", ""), (5, "https://t.org/a", SAME), (6, "https://t.org/b", "<p>Jo Poe 203-555-0140</p>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_structural_parts_go_and_are_counted(pages):
    rows = {r["page_id"]: r for r in staff_pages.sanitized(pages).collect()}
    assert [rows[1][k] for k in staff_pages.COUNTED] == [2, 1, 6]
    for lost in ("Robert Roe", "Al Roe", "Zed Zoe", "RZ.module", "inner"):
        assert lost not in rows[1]["html"]
    for kept in ("Jane Doe", "Carl Dow", "Tom Ray", "var a", 'href="mailto:cd@t.org"'):
        assert kept in rows[1]["html"]
    assert rows[3]["html"] is None and rows[4]["html"] == "" and rows[2]["structural_blocks"] == 0


def test_markup_reads_back_as_the_same_document():
    text = '<div a="1 &amp; &quot;2&quot;">x &lt; y<br><p>z</p><script>a < b && c</script></div>'
    assert staff_pages.markup(parse(text)) == staff_pages.markup(parse(staff_pages.markup(parse(text))))
    assert parse(staff_pages.markup(parse(text))).text() == parse(text).text()


def test_intervals_hold_their_descendants():
    spans = staff_pages.intervals(parse("<div><p>a<b>c</b></p><ul><li>x<li>y</ul></div><p>z</p>"))
    place = {id(x): (i, e) for x, i, e in spans}
    for x, i, e in spans:
        inside = {j for y in x.walk() for j in [place[id(y)][0]]}
        assert inside == set(range(i, e))


def test_sections_profiles_and_fields(pages):
    rows = [(r["page_id"], r["source_kind"], r["name"], r["title"], r["department"], r["email"], r["phone"], r["phone_ext"]) for r in staff_pages.read_outlines(staff_pages.outlines(pages)).collect()]
    assert (1, "department_section", "Jane Doe", None, "Building Office", None, "2035550100", None) in rows
    assert (1, "department_section", "Ann Bell", "Clerk", "Building Office", "ann@t.org", None, None) in rows
    assert (1, "profile_block", "Mary Poe", None, "Building Office", "mp@t.org", None, None) in rows
    assert (2, "single_profile_page", "Pat Lee", "Clerk", "Main Hall", None, "2035550120", "4") in rows
    assert not any(r[6] in ("2035550109", "2035550108", "2035550111") for r in rows) and {r[0] for r in rows} == {1, 2, 5}


def test_rows_of_one_person_merge_in_the_order_of_the_readers(spark, pages):
    rows = {(r["page_id"], r["name"]): r for r in staff_pages.assembled(pages).collect()}
    jane = rows[5, "Jane Doe"]
    assert (jane["sightings"], jane["confidence"], jane["source_kind"], jane["phone"]) == (3, 0.86, "reconstructed_contact_block", "2035550130")
    assert rows[1, "Tom Ray"]["department"] == "Assessor" and rows[1, "Tom Ray"]["source_kind"] == "table"
    assert rows[6, "Jo Poe"]["source_kind"] == "generic"
    assert not any(p in (3, 4) for p, _ in rows)


def test_the_order_differs_on_pages_of_departments(spark):
    fields = "page_id long, source_kind string, block_no int, name string, title string, department string, email string, phone string, phone_ext string, source_context string, confidence double"
    two = [(k, "profile_block", 0, "Jane Doe", None, "From profile", None, "1", None, "p", 0.79) for k in (1, 2)] + [(k, "labeled_staff", 0, "Jane  DOE", None, "From labels", "j@t.org", "1", "9", "l", 0.81) for k in (1, 2)]
    about = spark.createDataFrame([(1, "Page", True), (2, None, False)], "page_id long, page_department string, on_department boolean")
    got = {r["page_id"]: (r["department"], r["email"], r["phone_ext"], r["confidence"], r["sightings"]) for r in staff_pages.merged(spark.createDataFrame(two, fields), about).collect()}
    assert got == {1: ("From labels", "j@t.org", "9", 0.81, 2), 2: ("From profile", "j@t.org", "9", 0.81, 2)}


def test_a_section_is_read_to_its_end(spark):
    people = [f"Jane D{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(60)]
    html = "<h2>Building Office</h2>" + "".join(f"<p>{n}</p><p>Clerk</p><p>203-555-01{i:02}</p>" for i, n in enumerate(people))
    html += "<h3>Fire Division</h3>" + "<p>open daily</p>" * 40 + "<p>Ann Bell</p><p>Chief</p><p>203-555-0199</p>"
    pages = spark.createDataFrame([(1, "https://t.org/x", html)], "page_id long, url string, html string")
    rows = {r["name"]: (r["title"], r["department"], r["phone"]) for r in staff_pages.assembled(pages).collect()}
    assert rows == {n: ("Clerk", "Building Office", f"20355501{i:02}") for i, n in enumerate(people)} | {"Ann Bell": ("Chief", "Fire Division", "2035550199")}
