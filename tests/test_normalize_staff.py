import pytest
from pyspark.sql import functions as F

from townlens.operators import normalize_staff as n

FIELDS = ("name", "title", "department", "email", "phone", "phone_ext", "source_context", "source_kind", "page_class", "source_url", "confidence")
SCHEMA = "i int, " + ", ".join(f"{f} {'double' if f == 'confidence' else 'string'}" for f in FIELDS)
GOOD = {"name": "Jane Doe", "title": "Town Clerk", "department": "Tax & Revenue", "email": "J@t.org", "phone": "203-555-0100", "source_kind": "table_directory", "page_class": "Department_Page", "source_url": "https://t.org/x", "confidence": 0.9}
#: Changes to GOOD, the rules that speak in order, and what the row then is.
CASES = [
    ({}, [], {"name": "Jane Doe", "phone": "2035550100", "email": "j@t.org", "confidence": 0.9, "is_likely_noise": 0, "block_class": "person_block", "normalization_flag": None, "source_context": "revize:table_directory|page_class=department_page|page_priority=0.75"}),
    ({"name": "Vacant position"}, None, {"drop": "vacancy"}),
    ({"name": "Click here now"}, ["name_clear_reject", "name_invalid_pattern", "office_contact"], {"name": None, "title": "Department Contact", "confidence": 0.46}),
    ({"name": "12 Elm Street"}, ["name_address_like"], {"normalization_flag": "weak_person_name", "confidence": 0.46}),
    ({"name": "Quick Links"}, ["name_non_person_label"], {"name": "Quick Links"}),
    ({"name": "Zoning Board", "department": None}, ["name_is_department", "office_contact"], {"name": None, "department": "Zoning Board", "title": "Department Contact", "block_class": "office_contact_block", "source_kind": "department_contact_block"}),
    ({"name": "Deputy Mayor", "title": None}, ["name_is_title", "office_contact"], {"name": None, "title": "Department Contact"}),
    ({"name": "Government"}, ["name_generic_heading"], {"name": "Government"}),
    ({"name": "Madonna", "title": None}, ["name_invalid_pattern", "name_not_accepted"], {"name": "Madonna"}),
    ({"title": "View details"}, ["title_action_label"], {"title": None}),
    ({"department": "Read more"}, ["department_action_label"], {"department": None, "normalization_flag": "department_contamination"}),
    ({"department": "5 Main St"}, ["department_address_like"], {"department": None}),
    ({"department": "Education"}, ["department_ambiguous_education"], {"department": None}),
    ({"department": "Education", "source_url": "https://t.org/education"}, [], {"department": "Education"}),
    ({"department": "RFP list"}, ["department_context_noise"], {"department": None}),
    ({"name": None, "title": "Clerk", "department": None, "source_url": "https://t.org/departments/land-use/"}, ["office_contact"], {"title": "Department Contact", "department": "Land Use"}),
    ({"title": None, "email": None, "phone": None}, ["name_without_contact", "no_contact_method"], {"normalization_flag": "missing_contact_method"}),
    ({"name": None, "title": None, "department": None, "email": None, "phone": None}, ["no_contact_method"], {"drop": "missing_person_and_context"}),
    ({"phone": "20 3-555-0100 x 12", "source_context": "call 20 3-555-0100 x 12"}, [], {"phone": "2035550100", "phone_ext": "12", "source_context": "revize:table_directory|page_class=department_page|page_priority=0.75 | call 203-555-0100x 12"}),
    ({"source_url": "https://t.org/contact-us", "source_kind": None, "name": "Madonna", "confidence": None}, [], {"confidence": 0.54, "source_kind": "unknown", "block_class": "office_contact_block"}),
    ({"page_class": None, "confidence": 0.0}, [], {"confidence": 0.58, "page_class": "generic"}),
]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, *[{**GOOD, **c}.get(f) for f in FIELDS]) for i, (c, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(data, SCHEMA).withColumns({"ledger": F.lit("x"), "_other": F.lit(1)})
    return {r["i"]: r for r in n.normalized(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_each_rule_speaks_and_demotes(rows, i):
    _, ledger, want = CASES[i]
    row = rows[i]
    assert {k: row[k] for k in want} == want
    if ledger is not None:
        assert row["ledger"] == ledger
        assert row["is_likely_noise"] == int(bool(ledger)) and (row["normalization_flag"] or "").split(",") == (sorted({n.LEDGER[r] for r in ledger}) or [""])
        if ledger:
            assert "noise=1;norm_flag=" in row["source_context"] and row["confidence"] <= n.NOISE_CAP
    assert len(row["source_context"]) <= 240 and row["_other"] == 1


def test_counts_of_the_ledger_and_empty_table(spark):
    df = spark.createDataFrame([(i, *[{**GOOD, **c}.get(f) for f in FIELDS]) for i, (c, _, _) in enumerate(CASES)], SCHEMA)
    counts = {r["rule"]: r["rows"] for r in n.ledger_counts(n.normalized(df)).collect()}
    assert counts["drop_vacancy"] == 1 and counts["no_contact_method"] == 2 and set(counts) <= {*n.LEDGER, "drop_vacancy", "drop_missing_person_and_context"}
    assert n.normalized(df.limit(0)).count() == 0
