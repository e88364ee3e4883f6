"""Role candidates: seven scores, flags, a state for each candidate, the winner of each town and role group, and the
groups that stay unresolved.

The candidate windows share the prefix (municipality_id, role_normalized), so one exchange serves the three of them; the
winner window needs a second by (municipality_id, role_group). Groups are the candidates of one role in one town.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions.text import blank_to_null, chain, filled, flag, has_any, low, norm, one_of, word_count
from townlens.operators.enrich import CHIEF_ROLES, VENDOR_TAG

# Tokens and weights of the scores.
PLANNING_ROLES = ("Land Use", "Planner", "Zoning Enforcement Officer", "ZEO")
DEPARTMENT_POINTS = {
    ("Assessor",): ("assessor", "assessment"),
    ("Tax Collector",): ("tax", "revenue"),
    ("Town Clerk",): ("clerk",),
    ("Building Official",): ("building", "inspection", "zoning"),
    PLANNING_ROLES: ("land use", "planning", "zoning"),
    ("Finance Director", "Treasurer"): ("finance", "treasurer", "accounting"),
    ("First Selectman",): ("selectman", "board of selectmen"),
    ("Mayor",): ("mayor",),
    ("Town Manager", "Town Administrator"): ("town manager", "town administrator"),
}
#: role: tokens in the title, in the department, in the url.
ROLE_TOKENS = {
    ("Assessor",): (("assessor",), ("assessor", "assessment"), ("assessor",)),
    ("Tax Collector",): (("tax", "revenue"), ("tax", "revenue"), ("tax",)),
    ("Town Clerk",): (("clerk",), ("clerk",), ("clerk",)),
    ("Building Official",): (("building", "inspection"), ("building", "inspection", "zoning"), ("building", "inspection")),
    PLANNING_ROLES: (("land use", "planner", "planning", "zoning"), ("land use", "planning", "zoning"), ("land-use", "planning", "zoning")),
    ("Finance Director",): (("finance", "treasurer", "accounting"), ("finance", "treasurer", "accounting"), ("finance", "treasurer")),
    ("Treasurer",): (("treasurer",), ("treasurer", "finance"), ("treasurer",)),
    ("First Selectman",): (("selectman",), ("selectman",), ("selectman",)),
    ("Mayor",): (("mayor",), ("mayor",), ("mayor",)),
}
SUSPICIOUS_POINTS = {"role_department_mismatch": -5, "invalid_person_name": -8, "role_only_name": -8, "contact_hub_candidate": -4, "assistant_role_contamination": -4, "low_context": -3, "non_person_role_candidate": -2}
ARTIFACT_TEXT = ("your link name", "click here", "email me", "affidavit", "vacanc")
ARTIFACT_NAMES = ("building", "land use", "tax collector", "assessor", "department", "office")
ROLE_WORDS = ("building", "land use", "planning", "assessor", "tax", "clerk", "finance", "zoning", "office", "department")
DOCUMENT_NAMES = ("development permit", "adopted march", "cover page", "zoning regulations", "certificate of zoning compliance", "application", "permit", "regulations", "ordinance", "form", "fees", "requirements")
DOCUMENT_TEXT = ("ordinance", "regulations", "application", "permit", "cover page", "fees", "requirements", "certificate of zoning compliance")
NAME_REASONS = ("invalid_person_name", "role_only_name")
SENIORITY = ("director", "chief", "official", "manager", "planner", "assistant")
STRUCTURES = ("revize_profile_card", "revize_staff_table", "revize_sidebar_contact", "revize_content_body")


def reachable() -> Column:
    return filled("email") | filled("phone")


def on(column: str) -> Column:
    return F.col(column) == 1


def tag(kind: str) -> Column:
    return F.col("source_context_norm").startswith(VENDOR_TAG + kind)


def page_is(kind: str) -> Column:
    return (F.col("page_type_norm") == kind) | F.col("source_context_norm").contains(f"page_class={kind}")


def structure() -> Column:
    staff = tag("labeled_staff")
    return chain(
        (tag("contact_card") | tag("profile_block"), STRUCTURES[0]),
        (tag("reconstructed_contact_block") | (staff & page_is("staff_directory")), STRUCTURES[1]),
        (staff & page_is("department_page") & reachable(), STRUCTURES[2]),
        (tag("department_section") | (staff & page_is("department_page")), STRUCTURES[3]),
        default="",
    )


def person_name_score() -> Column:
    n = F.trim(F.coalesce("name", F.lit("")))
    size = F.length(n)
    same = one_of(F.lower(n), norm("role_normalized"), norm("title"), norm("department"))
    when = lambda test, w: F.when(test, w).otherwise(0)
    return when(F.coalesce("entity_type", F.lit("")) == "person", 4) + when((n != "") & (word_count("name") >= 2), 4) + when(n.rlike("^[A-Z][^\\n]* [A-Z]"), 2) + when((n != "") & size.between(5, 60), 1) + when(same, -8)


def source_score() -> Column:
    return chain((page_is("staff_directory"), 5), (tag("reconstructed_contact_block"), 4), (page_is("department_page"), 2), (page_is("contact_hub"), -3), (one_of(F.col("page_type_norm"), "generic", "homepage", "other") | F.col("source_context_norm").contains("page_class=generic"), -5), default=0)


def contact_score() -> Column:
    when = lambda test, w: F.when(test, w).otherwise(0)
    return when(filled("email"), 2) + when(filled("phone"), 2) + when(filled("title"), 1) + when(filled("department"), 1) + when(filled("email") & filled("phone"), 1)


def department_score() -> Column:
    role, dept = F.col("role_normalized"), F.col("department_norm")
    return chain((F.col("suspicious_reason") == "role_department_mismatch", -6), *[(role.isin(*roles) & has_any(dept, *tokens), 3) for roles, tokens in DEPARTMENT_POINTS.items()], default=0)


def role_match_score() -> Column:
    role, title, dept, url = F.col("role_normalized"), F.col("title_norm"), F.col("department_norm"), F.col("source_url_norm")
    rules = [(role.isin(*roles) & (has_any(title, *t) | has_any(dept, *d) | has_any(url, *u)), 6) for roles, (t, d, u) in ROLE_TOKENS.items()]
    for name in ("town manager", "town administrator"):  # any character may stand between the words of the url
        rules.append(((F.col("role_norm") == name) & (title.contains(name) | dept.contains(name) | url.rlike(name.replace(" ", "."))), 6))
    return chain(*rules, (title.contains(F.col("role_norm")) | dept.contains(F.col("role_norm")), 5), default=0)


def artifact_name() -> Column:
    n = F.col("name_norm")
    padded = F.concat(F.lit(" "), n, F.lit(" "))
    return has_any(n, *ARTIFACT_TEXT) | one_of(n, "link name", *ARTIFACT_NAMES) | has_any(padded, " department ", " office ")


def role_only_person_name() -> Column:
    n, role, dept = F.col("name_norm"), F.col("role_norm"), F.col("department_norm")
    in_order = F.replace(n, F.lit(" "), F.lit(".*"))  # the words of the name, with anything between them
    echoed = F.rlike(role, in_order) | F.rlike(dept, in_order) | (one_of(n, "land use", "planning", "zoning") & (F.col("role_family") == "planning_zoning"))
    return (F.col("entity_type") == "person") & filled("name") & ((n == role) | (n == dept) | (one_of(n, *ROLE_WORDS) & echoed))


def document_name() -> Column:
    n = F.col("name_norm")
    on_page = F.col("source_context_norm").contains("page_class=department_page") & (tag("department_section") | tag("labeled_staff"))
    return on_page & (one_of(n, *DOCUMENT_NAMES) | has_any(n, *DOCUMENT_TEXT))


def allow_flags() -> dict[str, Column]:
    n, t, context = F.col("name_norm"), F.col("title_norm"), F.col("source_context_norm")
    real = on("is_revize") & (filled("role_normalized") | filled("role_family")) & (F.col("is_likely_noise") == 0)
    usual = ~has_any(n, *ARTIFACT_TEXT) & (n != "link name") & ~has_any(t, "vacanc", "share this page", "click here") & ~has_any(context, "share this page", "copy and paste this code")
    return {"artifact_structural_allow_flag": flag(real & (F.col("page_type_norm") != "contact_hub") & usual), "weak_source_structural_allow_flag": flag(real & reachable())}


def disqualifier() -> Column:
    """The first reason why a tagged candidate cannot win; empty for the others."""
    reason = F.coalesce("suspicious_reason", F.lit(""))
    tolerated = on("artifact_name_flag") & on("artifact_structural_allow_flag")
    rules = [
        (on("role_only_person_name_flag"), "invalid_person_name"),
        (on("revize_department_page_artifact_flag"), "revize_department_page_artifact"),
        (on("artifact_name_flag") & ~on("artifact_structural_allow_flag"), "artifact_name"),
        (on("blank_name_flag"), "blank_name"),
        (reason.isin(*NAME_REASONS) & ~tolerated, reason),
        (F.coalesce("entity_type", F.lit("")) != "person", "non_person_contact"),
        (reason.isin("contact_hub_candidate", "role_department_mismatch", "assistant_role_contamination", "low_context"), reason),
        ((F.col("page_type_norm") == "contact_hub") & ~tag("reconstructed_contact_block"), "contact_hub_candidate"),
        (~reachable(), "missing_email_and_phone"),
        ((F.col("person_name_score") < 7) & ~tolerated, "weak_name_quality"),
        (F.col("role_match_score") < 5, "weak_role_match"),
        ((F.col("source_score") + F.col("reconstruction_score") < 3) & ~on("weak_source_structural_allow_flag"), "weak_source_match"),
    ]
    return F.when(on("is_revize"), chain(*rules, default="")).otherwise("")


def score_candidates(enriched: DataFrame) -> DataFrame:
    """Every contact with a role, scored, ranked among the candidates of its town and role, and labelled."""
    df = enriched.filter(filled("role_normalized")).withColumns({"is_revize": flag(low("source_context").startswith(VENDOR_TAG)), "name_norm": norm("name"), "title_norm": norm("title"), "department_norm": norm("department"), "role_norm": norm("role_normalized"), "source_url_norm": low("source_url"), "page_type_norm": low("page_type"), "source_context_norm": low("source_context"), "is_likely_noise": F.coalesce("is_likely_noise", F.lit(0))})
    tagged = on("is_revize")
    df = df.withColumns({
        "source_structure_type": structure(),
        "person_name_score": person_name_score(),
        "source_score": source_score(),
        "reconstruction_score": F.when(tag("reconstructed_contact_block"), 4).otherwise(0),
        "contact_score": contact_score(),
        "department_score": department_score(),
        "role_match_score": role_match_score(),
        "suspicious_score": chain(*[(F.col("suspicious_reason") == k, v) for k, v in SUSPICIOUS_POINTS.items()], default=0),
        "blank_name_flag": flag(tagged & ~filled("name")),
        "artifact_name_flag": flag(tagged & artifact_name()),
        "role_only_person_name_flag": flag(tagged & role_only_person_name()),
        "revize_department_page_artifact_flag": flag(tagged & document_name()),
        **allow_flags(),
    })
    source = F.col("source_score") + F.col("reconstruction_score")
    total = F.col("person_name_score") + F.col("role_match_score") + source + F.col("contact_score") + F.col("department_score") + F.col("suspicious_score")
    df = df.withColumns({"strong_name_quality": flag(F.col("person_name_score") >= 7), "strong_role_match": flag(F.col("role_match_score") >= 5), "strong_source_match": flag(source >= 3), "candidate_score": total, "winner_disqualifier_reason": disqualifier()})

    clean = ~on("revize_department_page_artifact_flag") & ~on("role_only_person_name_flag") & ~on("blank_name_flag")
    strong = on("strong_name_quality") & on("strong_role_match") & on("strong_source_match") & (F.col("contact_score") >= 3) & (F.col("candidate_score") >= 12)
    tolerated = on("artifact_name_flag") & on("artifact_structural_allow_flag")
    bad_name = F.coalesce(F.col("suspicious_reason").isin(*NAME_REASONS), F.lit(False))
    described = filled("title") | filled("department")
    df = df.withColumns({
        "blank_name_fallback_eligible": flag(tagged & on("blank_name_flag") & (filled("role_normalized") | filled("role_family")) & reachable() & (F.col("is_likely_noise") == 0)),
        "high_confidence_eligible": flag(~tagged | (~on("artifact_name_flag") & clean & (F.coalesce("entity_type", F.lit("")) == "person") & ~filled("suspicious_reason") & strong)),
        "review_candidate_eligible": flag(tagged & clean & (~on("artifact_name_flag") | on("artifact_structural_allow_flag")) & (~bad_name | tolerated) & (filled("name") | described) & (reachable() | described)),
    })
    group = Window.partitionBy("municipality_id", "role_normalized")
    order = [F.desc("candidate_score"), F.round(F.coalesce("display_confidence", F.lit(0.0)), 9).desc(), F.coalesce("contact_id", F.lit("")).asc()]
    df = df.withColumns({"candidate_rank": F.row_number().over(group.orderBy(*order)), "high_confidence_rank": F.row_number().over(Window.partitionBy("municipality_id", "role_normalized", "high_confidence_eligible").orderBy(*order)), "eligible_candidate_count": F.sum("high_confidence_eligible").over(group)})
    state = chain((on("high_confidence_eligible") & on("high_confidence_rank"), "high_confidence_winner"), (tagged & on("review_candidate_eligible"), "candidate_for_review"), (tagged & on("blank_name_fallback_eligible"), "role_only_fallback"), default="disqualified")
    invalid = tagged & (on("role_only_person_name_flag") | on("revize_department_page_artifact_flag") | (on("artifact_name_flag") & ~on("artifact_structural_allow_flag")) | (bad_name & ~tolerated & ~on("blank_name_fallback_eligible")))
    return df.withColumns({"candidate_state": state, "invalid_candidate_disqualified": flag(invalid)})


def family_group() -> Column:
    """The role family of a tagged candidate, split by rank of the title in three families."""
    t, family = F.col("title_norm"), F.coalesce("role_family", F.lit(""))
    second = lambda name, *tokens: F.when(has_any(t, *tokens), f"{name}_secondary").otherwise(f"{name}_primary")
    zeo = has_any(t, "assistant", "zoning enforcement officer") | F.concat(F.lit(" "), t, F.lit(" ")).contains(" zeo ")
    planning = chain((has_any(t, "director", "planner"), "planning_zoning_primary"), (zeo, "planning_zoning_secondary"), default="planning_zoning_primary")
    return chain((family == "building", second("building", "assistant", "inspector")), (family == "planning_zoning", planning), (family == "assessor", second("assessor", "assistant")), default=F.coalesce(blank_to_null("role_family"), blank_to_null("role_normalized")))


def best_role_per_town(candidates: DataFrame) -> DataFrame:
    """One winner for each town and role group: state, reachability, structure, scores and title decide, in this order."""
    undisputed = (F.col("candidate_state") == "candidate_for_review") & (F.col("is_likely_noise") == 0) & ~filled("winner_disqualifier_reason")
    high, fallback = F.col("candidate_state") == "high_confidence_winner", F.col("candidate_state") == "role_only_fallback"
    df = candidates.filter(high | (on("is_revize") & (undisputed | fallback)))
    df = df.withColumn("role_group", F.when(on("is_revize"), family_group()).otherwise(blank_to_null("role_normalized")))
    order = [
        chain((high, 1), (undisputed, 2), (fallback, 3), default=4),
        chain((filled("name") & reachable(), 1), (filled("name"), 2), (reachable(), 3), default=4),
        chain(*[(F.col("source_structure_type") == s, i + 1) for i, s in enumerate(STRUCTURES)], default=5),
        F.desc("candidate_score"),
        F.round(F.coalesce("display_confidence", F.lit(0.0)), 9).desc(),
        chain(*[(low("title").contains(s), i + 1) for i, s in enumerate(SENIORITY)], default=7),
        F.coalesce("contact_id", F.lit("")).asc(),
    ]
    ranked = df.withColumns({"rn": F.row_number().over(Window.partitionBy("municipality_id", "role_group").orderBy(*order)), "forced_fallback": flag(~high)})
    return ranked.filter("rn = 1")


def unresolved_roles(candidates: DataFrame, winners: DataFrame) -> DataFrame:
    """Role groups of tagged candidates without a winner, with the leading candidate and the reason."""
    df = candidates.filter(on("is_revize")).withColumn("role_group", family_group())
    unnamed = on("blank_name_flag") | on("artifact_name_flag")
    untitled = ~filled("title") | has_any(F.col("title_norm"), "department", "office")
    nameless = ~filled("name") | on("blank_name_flag")
    most = lambda test: F.max(flag(test))
    order = F.struct(F.col("candidate_score").alias("s"), F.round(F.coalesce("display_confidence", F.lit(0.0)), 9).alias("d"))
    lead = Window.partitionBy("municipality_id", "role_group").orderBy(order.desc(), F.coalesce("contact_id", F.lit("")).asc())
    ranked = df.withColumn("role_group_rank", F.row_number().over(lead))
    top = F.first(F.when(F.col("role_group_rank") == 1, F.struct("role_normalized", "contact_id", "name", "title", "department", "email", "phone", "page_type", "source_url", "candidate_score", "candidate_state", "winner_disqualifier_reason")), ignorenulls=True)
    groups = ranked.groupBy("municipality_id", "role_group").agg(
        F.count("*").alias("candidate_count"),
        F.sum(flag(F.col("candidate_state") == "candidate_for_review")).alias("review_candidate_count"),
        F.sum("invalid_candidate_disqualified").alias("invalid_candidate_disqualified_count"),
        most(filled("name") & ~unnamed).alias("usable"),
        most(reachable()).alias("contact"),
        most(filled("role_normalized") | filled("role_family") | filled("title")).alias("evidence"),
        most(filled("department") & nameless & untitled).alias("department_only"),
        most(reachable() & (unnamed | F.coalesce(F.col("suspicious_reason").isin(*NAME_REASONS), F.lit(False)))).alias("fragmented"),
        top.alias("top"),
    )
    won = winners.filter(on("is_revize")).select("municipality_id", "role_group").distinct()
    reason = chain((on("fragmented") & on("contact") & on("evidence"), "fragmented_contact_structure"), (on("department_only") & ~on("usable"), "department_only"), (~on("usable") & ~on("contact"), "no_person_contact_available"), default="no_valid_candidates_after_filtering")
    names = {"contact_id": "contact_id", "name": "name", "title": "title", "department": "department", "email": "email", "phone": "phone", "page_type": "page_type", "source_url": "source_url", "score": "candidate_score", "state": "candidate_state", "winner_block_reason": "winner_disqualifier_reason"}
    return groups.join(won, ["municipality_id", "role_group"], "left_anti").select(
        "municipality_id",
        F.coalesce("top.role_normalized", "role_group").alias("role_normalized"),
        "candidate_count",
        "review_candidate_count",
        "invalid_candidate_disqualified_count",
        F.lit(1).alias("forced_fallback_blocked"),
        *[F.col(f"top.{source}").alias(f"top_candidate_{name}") for name, source in names.items()],
        reason.alias("unresolved_reason"),
    )


__all__ = ["CHIEF_ROLES", "best_role_per_town", "family_group", "score_candidates", "unresolved_roles"]
