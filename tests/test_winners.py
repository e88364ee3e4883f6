import pytest
from pyspark.sql import functions as F

from townlens.operators import candidates as cand
from townlens.operators import enrich

COLUMNS = "contact_id string, municipality_id string, name string, title string, department string, email string, email_type string, phone string, phone_ext string, address string, hours string, source_context string, source_url string, confidence double, entity_type string, role_normalized string, role_family string, department_normalized string, page_type string, suspicious_reason string, display_confidence double, record_rank int, is_likely_noise int"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
BASE = dict(contact_id="", municipality_id="ct_test", name="Name", title="", department="", email="", email_type="unknown", phone="", phone_ext="", address="", hours="", source_context="", source_url="", confidence=0.5, entity_type="person", role_normalized="", role_family="", department_normalized="", page_type="department_page", suspicious_reason=None, display_confidence=0.5, record_rank=1, is_likely_noise=0)
CARD, BODY = "revize:contact_card|page_class=staff_directory", "revize:department_section|page_class=department_page"


def contact(**over):
    return {**BASE, **over}


@pytest.fixture
def run(spark):
    def go(*rows):
        df = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in rows], COLUMNS)
        scored = cand.score_candidates(df).cache()
        won = cand.best_role_per_town(scored)
        return {r["contact_id"]: r for r in scored.collect()}, won.collect(), cand.unresolved_roles(scored, won).collect()

    return go


def test_department_mismatch_loses(run):
    finance = dict(role_normalized="Finance Director", role_family="finance", title="Finance Director", email="a@b.gov")
    _, won, _ = run(contact(contact_id="bad", name="Ann Bell", department="Board of Education", suspicious_reason="role_department_mismatch", display_confidence=0.98, **finance), contact(contact_id="good_finance", name="Carl Dow", department="Finance Department", display_confidence=0.74, **finance))
    assert [w["contact_id"] for w in won] == ["good_finance"]


def test_an_only_mismatch_still_surfaces(run):
    _, won, _ = run(contact(contact_id="only", name="Ann Bell", role_normalized="Finance Director", title="Finance Director", department="Board of Education", suspicious_reason="role_department_mismatch", email="a@b.gov"))
    assert [w["contact_id"] for w in won] == ["only"]


def test_structure_beats_score(run):
    planner = dict(role_normalized="Planner", role_family="planning_zoning", title="Town Planner", email="p@t.gov", phone="8605550000", department="Planning and Zoning")
    scored, won, _ = run(contact(contact_id="body", name="Ann Bell", source_context="revize:labeled_staff|page_class=department_page", page_type="department_page", department_normalized="Planning & Zoning", **planner), contact(contact_id="card", name="Carl Dow", source_context=CARD, page_type="staff_directory", **planner))
    assert [(w["contact_id"], w["role_group"]) for w in won] == [("card", "planning_zoning_primary")]
    assert scored["card"]["source_structure_type"] == "revize_profile_card"


def test_title_seniority_breaks_ties(run):
    same = dict(role_normalized="Finance Director", role_family="finance", department="Finance Department", phone="8605550300", source_context="revize:contact_card|page_class=department_page", display_confidence=0.72)
    scored, won, _ = run(contact(contact_id="a_manager", name="Avery Blake", title="Finance Manager", **same), contact(contact_id="z_director", name="Taylor Brooks", title="Director of Finance", **same))
    assert {r["candidate_state"] for r in scored.values()} == {"candidate_for_review"} and len({r["candidate_score"] for r in scored.values()}) == 1
    assert [w["contact_id"] for w in won] == ["z_director"]


def test_building_groups_win_apart(run):
    same = dict(role_normalized="Building Official", role_family="building", department="Building", email="p@t.gov", phone="8605550000", source_context=CARD, page_type="staff_directory")
    _, won, _ = run(contact(contact_id="a", name="Ann Bell", title="Building Official", **same), contact(contact_id="b", name="Carl Dow", title="Assistant Building Official", **same))
    assert {w["role_group"]: w["contact_id"] for w in won} == {"building_primary": "a", "building_secondary": "b"}


def test_artifact_name_wins_nothing(run):
    scored, won, open_ = run(contact(contact_id="x", name="Your Link Name", title="Town Clerk", role_normalized="Town Clerk", role_family="town_clerk", email="c@t.gov", page_type="contact_hub", source_context="revize:contact_card|page_class=contact_hub"))
    assert won == [] and scored["x"]["winner_disqualifier_reason"] == "artifact_name"
    assert [(u["unresolved_reason"], u["forced_fallback_blocked"]) for u in open_] == [("fragmented_contact_structure", 1)]


def test_weak_artifact_without_contact(run):
    _, won, open_ = run(contact(contact_id="x", name="Land Use", title="", role_normalized="Land Use", role_family="planning_zoning", source_context=BODY))
    assert won == [] and [u["unresolved_reason"] for u in open_] == ["no_person_contact_available"]


def test_blank_name_office_is_a_fallback(run):
    scored, won, _ = run(contact(contact_id="x", name="", entity_type="role", title="Tax Collector", role_normalized="Tax Collector", role_family="tax_collector", phone="8605550000", source_context=CARD, page_type="staff_directory"))
    assert scored["x"]["candidate_state"] == "role_only_fallback" and [w["contact_id"] for w in won] == ["x"]


def test_pipeline_from_base_rows(spark):
    base = {c: BASE[c] for c in NAMES[:14]} | dict(contact_id="c1", name="Jane Doe", title="Town Clerk", email="jane.doe@example.gov", phone="8605551000", confidence=0.88)
    df = spark.createDataFrame([tuple(base[c] for c in NAMES[:14])], ", ".join(COLUMNS.split(", ")[:14]))
    full = enrich.enrich_contacts(df)
    scored = cand.score_candidates(full)
    won = cand.best_role_per_town(scored)
    assert (enrich.clean_contacts(full).count(), scored.count(), won.count(), cand.unresolved_roles(scored, won).count()) == (1, 1, 1, 0)
    assert full.columns.count("record_rank") == 1 and full.filter("role_family = 'town_clerk' and dedupe_key = 'ct_test|town clerk|jane.doe@example.gov'").count() == 1


def test_properties(spark):
    from townlens.sources.staging import spark_table

    raw = spark_table(spark, "/root/testdata/sf0.001", "contacts")
    full = enrich.enrich_contacts(raw).cache()
    assert full.count() == raw.count() and full.select("contact_id").distinct().count() == raw.count()
    assert full.filter("record_rank = 1").count() == full.select("dedupe_key").distinct().count()
    shuffled = enrich.enrich_contacts(raw.orderBy(F.rand(3)).repartition(5))
    key = ["contact_id", "record_rank", "role_normalized", "suspicious_reason"]
    assert full.select(key).exceptAll(shuffled.select(key)).count() == 0
    scored = cand.score_candidates(full)
    won = cand.best_role_per_town(scored)
    assert won.groupBy("municipality_id", "role_group").count().filter("count > 1").count() == 0
