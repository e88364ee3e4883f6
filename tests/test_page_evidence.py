import pytest

from townlens.operators import page_evidence

U = "https://t.example.org/"
PAGES = {
    1: (U + "x", "<aside id='staff-dr'><div class='a staff'>A</div><div class=\"staff\">B</div></aside>", None, "sidebar_staff", "staff_directory", True),
    2: (U + "x", "<div class='contact-name'>A</div>", None, "contact_card", "generic", True),
    3: (U + "x", "<p>Jane Doe, Clerk <a href='mailto:a@b.c'>m</a></p>", None, "inline_staff_list", "generic", True),
    4: (U + "x", "<strong>Finance</strong><p>Director: Ann</p>", None, "labeled_staff", "department_page", True),
    5: (U + "x", "<p>Name: A Title: B Phone - 1</p>", None, "single_profile_page", "generic", True),
    6: (U + "x", "<table><tr><th>Name</th><th>E-mail</th></tr></table><table><tr><td>Name</td><td>Office <b>phone</b></td></tr></table>", None, "table_directory", "staff_directory", True),
    7: (U + "x", "a@b.org 203-555-0100 c@d.org 203-555-0101 read more read more", None, "profile_block", "generic", True),
    8: (U + "x", "<h2>Police <i>Division</i></h2>", None, "department_section", "generic", False),
    9: (U + "departments/x", "<p>x</p>", None, "unknown", "department_page", False),
    10: (U + "contact_us", "<p>x</p>", None, "unknown", "contact_hub", False),
    11: (U + "staff-directory", "<p>email</p>", 200, "unknown", "staff_directory", True),
    12: (U + "staff-directory", "<p>email</p>", 404, "unknown", "generic", False),
    13: (None, None, None, "unknown", "generic", False),
    14: ("", "", 500, "unknown", "generic", False),
    15: (U + "x", "<p>Contact us</p> Directory of services", None, "unknown", "contact_hub", False),
    16: (U + "x", "<p>Departments > Tax</p>", None, "unknown", "department_page", False),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, u, h, s, 7, "x") for i, (u, h, s, *_) in PAGES.items()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, code int, header_hits int, blob string")
    return {r["page_id"]: r for r in page_evidence.staff_page_kinds(df, status="code").collect()}


def test_every_kind_of_page(found):
    got = {i: (r["source_type"], r["page_class"], r["page_kind"] != "unknown") for i, r in found.items()}
    assert got == {i: tuple(p[3:]) for i, p in PAGES.items()}


def test_counters_and_signals(found):
    assert found[1]["sidebar_staff_hits"] == 2 and found[6]["header_hits"] == 3 and found[7]["profile_block_hits"] == 2 and found[7]["read_more_hits"] == 2
    assert found[5]["key_value_hits"] == 3 and found[8]["department_section_hits"] == 1 and found[15]["contact_hub_hits"] == 2 and found[10]["contact_hub_hits"] == 2
    assert found[16]["signals"] == ["context:department_breadcrumb"] and found[13]["signals"] == []
    assert found[11]["signals"] == ["text:staff_contact_terms", "url:directory_path"]
    assert found[1]["page_priority_score"] == 1.0 and found[4]["page_priority_score"] == 0.75


def test_rows_that_are_text_of_documents(spark):
    long = "words " * 30
    cases = [
        ("contact_card", "Jane Doe", None, "a permit", "document_content", False), ("contact_card", "Jane Doe", None, "a permit" + long, "document_content", True), ("contact_card", "Jane Doe", None, long, "contact_card", False),
        ("labeled_staff", "Jane Doe", None, long, "department_content", True), ("labeled_staff", "Jane Doe", "Clerk", long, "staff_row", False), ("department_section", "Jane Doe", "Clerk", "One. Two.", "department_content", True),
        ("department_section", "Jane Doe", "Clerk", "short", "department_content", False), ("table_directory", "adopted MARCH", "Clerk", "x", "document_content", True), ("table_directory", "x1", "Clerk", "x", "document_content", True),
        (None, None, None, None, "unknown", False), ("", "Madonna", None, "", "unknown", False), ("labeled_staff", "A B", None, "x: y: z", "department_content", True),
    ]
    df = spark.createDataFrame([(i, k, n, t, c, None, None, None, None) for i, (k, n, t, c, *_) in enumerate(cases)], "i int, source_kind string, name string, title string, source_context string, department string, email string, phone string, phone_ext string")
    got = [(r["block_type"], r["non_contact"]) for r in page_evidence.non_contacts(df).orderBy("i").collect()]
    assert got == [c[4:] for c in cases]
    lined = df.selectExpr("*", "array('permit', 'a: b: c') AS lines")
    assert {r["block_type"] for r in page_evidence.non_contacts(lined).collect()} == {"document_content"}
