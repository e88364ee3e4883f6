"""Contact rows of staff pages brought into one form: words in the wrong field move, doubtful rows are demoted and say why.

The rules run in a fixed order and each sees what those before it left. A row carries a ledger of the rules that spoke; flags,
noise, the caps on its confidence and the tags of its context all follow from the ledger. Column expressions over one row; each
step is computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.functions import people
from townlens.functions.people import clean
from townlens.functions.text import c, chain, has_any, let
from townlens.operators import extract, fragments, routes

# Words that no name holds, what contaminates a department, urls of contact hubs, caps on confidence.
CLEAR_REJECTS = ("email me", "click here", "request", "office hours")
CONTAMINATION = ("bids and rfp", "rfp", ", ct", " main street")
HUB_URLS = ("/contact", "contact_us", "contact-us", "staff_directory", "directory")
OFFICE_CAP, HUB_CAP, TITLE_CAP, NOISE_CAP, DEFAULT = 0.62, 0.54, 0.50, 0.46, 0.58
OFFICE, OFFICE_TITLE, CONTEXT = "department_contact_block", "Department Contact", 240
#: The rules in their order, each with the flag it sets.
LEDGER = {
    "name_clear_reject": "invalid_name", "name_address_like": "weak_person_name", "name_non_person_label": "weak_person_name", "name_is_department": "role_only_row", "name_is_title": "role_only_row", "name_generic_heading": "weak_person_name", "name_invalid_pattern": "weak_person_name",
    "title_action_label": "weak_person_name", "department_action_label": "department_contamination", "department_address_like": "department_contamination", "department_ambiguous_education": "department_contamination", "department_context_noise": "department_contamination",
    "office_contact": "role_only_row", "several_contacts": "weak_person_name", "name_without_contact": "missing_contact_method", "name_without_support": "weak_person_name", "no_contact_method": "missing_contact_method", "name_not_accepted": "weak_person_name",
}
STATE = ("name", "title", "department", "email", "phone", "phone_ext", "context", "kind", "page_class", "priority", "url", "block", "confidence", "ledger", "drop")


def blank(x: Column) -> Column:
    return F.coalesce(x, F.lit("")) == ""


def nothing(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def action(x: Column) -> Column:
    low = F.lower(clean(x))
    return low.isin(*people.ACTION_TEXTS) | has_any(low, *people.ACTION_PARTS)


def changed(s: Column, said: list[tuple[str, Column]], **fields: Column) -> Column:
    """The state with new fields, and the rules that spoke at the end of its ledger."""
    spoke = F.filter(F.array(*[F.when(test, rule) for rule, test in said]), lambda x: x.isNotNull()) if said else None
    ledger = F.concat(s["ledger"], spoke) if said else s["ledger"]
    return F.struct(*[(ledger if f == "ledger" else fields.get(f, s[f])).alias(f) for f in STATE])


def judge_name(s: Column) -> Column:
    low = F.lower(clean(s["name"]))
    named, clear = ~blank(s["name"]), low.rlike(r"https?://|www\.") | has_any(low, *CLEAR_REJECTS)

    def rest(x: Column) -> Column:
        name, low = x["name"], F.lower(clean(x["name"]))
        department, title = people.is_department(name), people.is_title(name)
        label = low.isin(*people.NAME_LITERALS) | has_any(low, *people.NAME_PHRASES, *people.NAME_FRAGMENTS)
        generic = low.isin(*people.GENERIC_HEADINGS)
        said = [("name_clear_reject", x["clear"]), ("name_address_like", people.is_place(name)), ("name_non_person_label", label), ("name_is_department", department), ("name_is_title", ~department & title), ("name_generic_heading", ~department & ~title & generic), ("name_invalid_pattern", ~department & ~title & ~generic & ~people.accepts_name(name, x["s"]["title"]))]
        moved = F.when(~department & ~title, name)
        return changed(x["s"], [(rule, x["named"] & test) for rule, test in said], name=moved, title=F.coalesce(x["s"]["title"], F.when(~department & title, name)), department=F.coalesce(x["s"]["department"], F.when(department, name)))

    return let(F.struct(s.alias("s"), F.when(named & ~clear, s["name"]).alias("name"), (named & clear).alias("clear"), named.alias("named")), rest)


def judge_title(s: Column) -> Column:
    bad = ~blank(s["title"]) & action(s["title"])
    return changed(s, [("title_action_label", bad)], title=F.when(~bad, s["title"]))


def judge_department(s: Column) -> Column:
    d, low = s["department"], F.lower(F.trim(F.coalesce(s["department"], F.lit(""))))
    stray = (low == "education") & ~F.lower(F.coalesce(s["url"], F.lit(""))).contains("education") & ~F.lower(s["context"]).contains("education department")
    rule = F.when(blank(d), None).otherwise(chain((action(d), "department_action_label"), (people.is_place(d), "department_address_like"), (stray, "department_ambiguous_education"), (has_any(low, *CONTAMINATION), "department_context_noise")))
    return let(F.struct(s.alias("s"), rule.alias("rule")), lambda x: changed(x["s"], [(r, x["rule"] == r) for r in LEDGER if r.startswith("department_")], department=F.when(x["rule"].isNull() & ~blank(x["s"]["department"]), F.coalesce(people.department_label(x["s"]["department"]), x["s"]["department"]))))


def judge_office(s: Column) -> Column:
    office = s["name"].isNull() & F.coalesce(s["email"], s["phone"], s["title"], s["department"]).isNotNull()

    def rest(x: Column) -> Column:
        s, office = x["s"], x["office"]
        title = F.when(office & (blank(s["title"]) | people.is_title(s["title"])), F.lit(OFFICE_TITLE)).otherwise(s["title"])
        department = F.coalesce(s["department"], x["from_url"])
        department = F.when(office, F.when(~people.is_title(department), department)).otherwise(s["department"])
        kind = F.when(office, OFFICE).otherwise(s["kind"])
        several = (F.greatest(F.size(extract.emails(s["context"])), F.size(extract.phones(s["context"]))) > 1) & s["name"].isNull() & (kind != OFFICE)
        return changed(s, [("office_contact", office), ("several_contacts", several)], title=title, department=department, kind=kind, block=F.when(office, "office_contact_block").otherwise(s["block"]))

    return let(F.struct(s.alias("s"), office.alias("office"), F.when(office, fragments.url_department(s["url"])).alias("from_url")), rest)


def judge_support(s: Column) -> Column:
    accepted = people.accepts_name(s["name"], s["title"])
    bare = s["name"].isNotNull() & F.coalesce(s["title"], s["email"], s["phone"]).isNull()
    said = [("name_without_contact", bare & accepted), ("name_without_support", bare & ~accepted), ("no_contact_method", s["email"].isNull() & s["phone"].isNull()), ("name_not_accepted", s["name"].isNotNull() & ~accepted)]
    return changed(s, said, drop=F.coalesce(s["drop"], F.when(F.coalesce(s["name"], s["title"], s["department"]).isNull(), "missing_person_and_context")))


def first_state(r: Column) -> Column:
    """What a row says before any rule: split digits joined, phone and extension read, the context tagged."""
    text = lambda f: nothing(people.joined_digits(r[f]))
    trimmed = lambda f: F.trim(F.coalesce(r[f], F.lit("")))
    context, kind = people.joined_digits(r["source_context"]), F.coalesce(nothing(trimmed("source_kind")), F.lit("unknown"))
    page_class = F.coalesce(nothing(F.lower(trimmed("page_class"))), F.lit("generic"))
    reached = F.concat(trimmed("email"), trimmed("phone"))
    block = chain((F.lower(kind) == OFFICE, "office_contact_block"), (people.is_person(people.joined_digits(r["name"])) & (F.concat(clean(r["title"]), reached) != ""), "person_block"), (reached != "", "office_contact_block"), default="structural_block")
    whole = people.joined_digits(F.concat_ws(" | ", nothing(trimmed("phone")), nothing(context), F.concat(F.lit("x"), nothing(trimmed("phone_ext")))))
    spoken = fragments.spoken(whole, nothing(trimmed("phone_ext")))

    def put(x: Column) -> Column:
        priority = routes.by_class(x["page_class"], routes.CLASS_WEIGHT)
        tagged = F.concat(F.lit("revize:"), F.lower(x["kind"]), F.lit("|page_class="), x["page_class"], F.lit("|page_priority="), F.format_string("%.2f", priority), F.when(x["context"] != "", F.concat(F.lit(" | "), x["context"])).otherwise(""))
        known = {"context": F.substring(tagged, 1, CONTEXT), "priority": priority, "phone": x["spoken"]["phone"], "phone_ext": x["spoken"]["ext"], "ledger": F.array().cast("array<string>"), "drop": F.when(people.is_vacancy(x["name"]), "vacancy")}
        return F.struct(*[(known[f] if f in known else x[f]).alias(f) for f in STATE])

    start = {"name": text("name"), "title": text("title"), "department": text("department"), "email": nothing(F.lower(trimmed("email"))), "context": context, "kind": kind, "page_class": page_class, "url": r["source_url"], "block": block, "confidence": F.coalesce(F.nullif(r["confidence"], F.lit(0.0)), F.lit(DEFAULT)), "spoken": spoken}
    return let(F.struct(*[v.alias(k) for k, v in start.items()]), put)


def normalized(rows: DataFrame) -> DataFrame:
    """rows (name, title, department, email, phone, phone_ext, source_context, source_kind, page_class, source_url, confidence,
    and any others but the names below) in one form, with email_type, block_class, is_likely_noise, normalization_flag (sorted,
    by commas), ledger, and drop: vacancy or missing_person_and_context, for rows that are no contacts at all."""
    raw = F.struct("name", "title", "department", "email", "phone", "phone_ext", "source_context", "source_kind", "page_class", "source_url", F.col("confidence").cast("double").alias("confidence"))
    state = let(raw, first_state)
    for judge in (judge_name, judge_title, judge_department, judge_office, judge_support):
        state = let(state, judge)
    judged = rows.select("*", F.explode(F.array(state)).alias("_s"))  # one row each: what reads the state does not repeat its rules
    s = c("_s")
    flags = F.array_sort(F.array_distinct(F.transform(s["ledger"], lambda r: F.element_at(F.create_map(*[F.lit(x) for kv in LEDGER.items() for x in kv]), r))))
    noise = F.size(s["ledger"]) > 0
    caps = [
        ((s["kind"] == OFFICE) | (s["block"] == "office_contact_block"), OFFICE_CAP), (has_any(F.lower(F.coalesce(s["url"], F.lit(""))), *HUB_URLS) & (s["name"].isNull() | (s["block"] != "person_block")), HUB_CAP),
        ((s["kind"] == OFFICE) & people.is_title(s["title"]) & ~F.lower(F.coalesce(s["title"], F.lit(""))).contains("department contact"), TITLE_CAP), (noise, NOISE_CAP),
    ]
    confidence = F.least(F.round(s["confidence"], 3), *[F.when(test, F.lit(cap)) for test, cap in caps])
    tags = F.concat_ws(";", F.when(noise, "noise=1"), F.when(noise, F.concat(F.lit("norm_flag="), F.array_join(flags, ","))))
    context = F.when(noise, F.substring(F.concat(s["context"], F.lit(" | "), tags), 1, CONTEXT)).otherwise(s["context"])
    own = {"name": s["name"], "title": s["title"], "department": s["department"], "email": s["email"], "phone": s["phone"], "phone_ext": s["phone_ext"], "source_context": context, "source_kind": s["kind"], "page_class": s["page_class"], "confidence": confidence, "block_class": s["block"], "is_likely_noise": noise.cast("int"), "normalization_flag": F.when(noise, F.array_join(flags, ",")), "ledger": s["ledger"], "drop": s["drop"]}
    others = [x for x in rows.columns if x not in own and x != "email_type"]
    return judged.select(*others, *[v.alias(k) for k, v in own.items()]).withColumn("email_type", extract.email_type("email"))


def ledger_counts(rows: DataFrame) -> DataFrame:
    """(rule, rows): how often each rule spoke, drops included."""
    spoke = F.concat("ledger", F.when(c("drop").isNotNull(), F.array(F.concat(F.lit("drop_"), c("drop")))).otherwise(F.array().cast("array<string>")))
    return rows.select(F.explode(spoke).alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))
