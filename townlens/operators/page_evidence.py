"""What kind of staff page a page is, from counters over its markup and text; and which contact rows are content of documents.

All of it is column expressions over one row a page: each counter is one pattern, counters are computed once and the rules read
them. Null and empty pages count nothing and are `unknown` and `generic`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.functions.people import clean, is_department
from townlens.functions.text import c, chain, has_any, let, low
from townlens.operators import extract, routes

# Words of staff pages, header words of contact tables, labels of profile fields, patterns of the counters.
DETECTION = ("staff directory", "contact", "email", "phone", "read more")
HEADER_HINTS = ("name", "title", "department", "phone", "email", "location", "profession", "office")
PROFILE_KEYS = ("name", "title", "department", "phone", "email", "location", "profession")
ASIDE = r"(?is)<aside[^>]*id\s*=\s*(?:\"staff-dr\"|'staff-dr'|staff-dr)[^>]*>(.*?)</aside>"
STAFF_DIV = r"(?is)<div[^>]*class\s*=\s*(?:\"[^\"]*\bstaff\b[^\"]*\"|'[^']*\bstaff\b[^']*')[^>]*>"
CONTACT_NAME = r"(?is)class\s*=\s*(?:\"[^\"]*contact-name[^\"]*\"|'[^']*contact-name[^']*')"
INLINE = r"\b[A-Z][a-zA-Z'`.-]+(?:\s+[A-Z][a-zA-Z'`.-]+){1,2}\s*,\s*[A-Za-z]"
LABELED = r"(?i)\b(?:manager|clerk|director|administrator|assessor|collector|chief)\s*:\s*[A-Z]"
HEADING = r"(?is)<(?:h1|h2|h3|h4|strong)[^>]*>(.*?)</(?:h1|h2|h3|h4|strong)>"
MAILED = r"(?i)mailto\s*:\s*([A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,})"
COUNTERS = ("sidebar_staff_hits", "contact_card_hits", "inline_staff_hits", "labeled_staff_hits", "header_hits", "profile_block_hits", "department_section_hits", "breadcrumb_department_hits", "contact_hub_hits", "key_value_hits", "read_more_hits")


def without_tags(x: Column) -> Column:
    return clean(F.regexp_replace(x, r"(?s)<[^>]+>", " "))


def found(x: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(x, F.lit(pattern), F.lit(group))


def table_headers(table: Column) -> Column:
    """Header cells of a table, or the cells of its first row where it has none."""
    cells = lambda x, p: F.filter(F.transform(found(x, p, 1), routes.plain), lambda t: t != "")
    first_row = F.regexp_extract(table, r"(?is)<tr[^>]*>(.*?)</tr>", 1)
    return let(cells(table, r"(?is)<th[^>]*>(.*?)</th>"), lambda h: F.when(F.size(h) > 0, h).otherwise(cells(first_row, r"(?is)<t[dh][^>]*>(.*?)</t[dh]>")))


def header_hits(html: Column) -> Column:
    """The most header words that one table of the page shows."""
    token = lambda x: F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))
    hits = lambda t: let(F.array_join(F.transform(table_headers(t), token), "\n"), lambda h: sum((h.contains(w).cast("int") for w in HEADER_HINTS), F.lit(0)))
    return F.coalesce(F.array_max(F.transform(found(html, r"(?is)<table[^>]*>(.*?)</table>", 1), hits)), F.lit(0))


def counters(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """pages with the columns of COUNTERS, and `blob`, the text in lower case. A page's own columns of these names go."""
    kept = pages.drop(*[x for x in (*COUNTERS, "blob") if x not in (url, html)])
    page, u = F.coalesce(c(html), F.lit("")), low(url)
    rows = kept.withColumn("_text", without_tags(page)).withColumn("blob", F.lower("_text"))
    blob, count = F.col("blob"), F.regexp_count
    mails = F.size(F.array_distinct(F.concat(extract.emails("_text"), F.transform(found(page, MAILED, 1), F.lower))))
    phones = F.size(extract.phones("_text"))
    read_more = F.regexp_count(blob, F.lit("read more"))
    hub = F.when(has_any(u, "contact_us", "directory_of_services"), 2).otherwise(0) + blob.contains("contact us").cast("int") + blob.contains("directory of services").cast("int")
    values = {
        "sidebar_staff_hits": count(F.regexp_extract(page, ASIDE, 1), F.lit(STAFF_DIV)), "contact_card_hits": count(page, F.lit(CONTACT_NAME)),
        "inline_staff_hits": (F.lower(page).contains("mailto:") & c("_text").rlike(INLINE)).cast("int"), "labeled_staff_hits": c("_text").rlike(LABELED).cast("int"), "header_hits": header_hits(page),
        "profile_block_hits": F.least(mails, phones, F.greatest(read_more, F.lit(1))), "department_section_hits": F.size(F.filter(F.transform(found(page, HEADING, 1), routes.plain), is_department)),
        "breadcrumb_department_hits": (blob.contains("departments") & (blob.contains(" > ") | blob.contains("breadcrumb"))).cast("int"), "contact_hub_hits": hub,
        "key_value_hits": sum((blob.rlike(rf"\b{k}\s*[:\-]").cast("int") for k in PROFILE_KEYS), F.lit(0)), "read_more_hits": read_more,
    }
    return rows.withColumns(values).drop("_text")


def source_type() -> Column:
    """What the counters say that a page lists its people in."""
    n = F.col
    return chain(
        (n("sidebar_staff_hits") >= 1, "sidebar_staff"), (n("contact_card_hits") >= 1, "contact_card"), (n("inline_staff_hits") >= 1, "inline_staff_list"), (n("labeled_staff_hits") >= 1, "labeled_staff"),
        ((n("key_value_hits") >= 3) & (n("profile_block_hits") <= 1) & (n("header_hits") == 0), "single_profile_page"), (n("header_hits") >= 2, "table_directory"),
        (n("profile_block_hits") >= 2, "profile_block"), (n("department_section_hits") >= 1, "department_section"), default="unknown",
    )


def staff_page_kinds(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", status: str | None = None) -> DataFrame:
    """page_id, page_kind (staff_directory_or_profile or unknown), source_type, page_class, page_priority_score, the counters,
    and `signals`, the sorted names of what was seen. status: a column with the answer's code; null counts as fine."""
    code = F.lit(None).cast("int") if status is None else pages[status].cast("int")
    rows = counters(pages.select(pages[id_col].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"), code.alias("status")))
    n, u, blob = F.col, low("url"), F.col("blob")
    says = lambda *words: has_any(blob, *words)
    strong = (n("sidebar_staff_hits") >= 1) | (n("contact_card_hits") >= 1) | (n("inline_staff_hits") >= 1) | (n("labeled_staff_hits") >= 1) | (n("header_hits") >= 2) | (n("profile_block_hits") >= 2) | (n("key_value_hits") >= 3)
    directory = (says("staff directory") | u.contains("directory")) & says("email") & says("phone")
    named = has_any(u, "staff_directory.php", "/staff-directory") & says("email", "phone")
    fine = n("status").isNull() | n("status").between(200, 399)
    rows = rows.withColumns({"source_type": source_type(), "matched": fine & (strong | directory | named)})
    rows = rows.withColumn("first_class", routes.page_class("url", "source_type", F.lit(""), blob))
    first = F.col("first_class")
    blocks = (n("contact_card_hits") >= 1) | (n("inline_staff_hits") >= 1) | (n("labeled_staff_hits") >= 1)
    department = u.contains("/departments/") | (n("breadcrumb_department_hits") >= 1) | ((n("department_section_hits") >= 1) & blocks)
    hub = (n("contact_hub_hits") >= 2) | (u.contains("contact") & (n("profile_block_hits") <= 1) & (n("header_hits") <= 1) & (n("sidebar_staff_hits") == 0))
    final = chain(
        ((n("header_hits") >= 2) | (n("sidebar_staff_hits") >= 1), "staff_directory"), ((first != "staff_directory") & department, "department_page"),
        (~first.isin("staff_directory", "department_page") & hub, "contact_hub"), (~n("matched"), "generic"), default=first,
    )
    seen = {
        "url:staff_directory.php": u.contains("staff_directory.php"), "url:directory_path": has_any(u, "/staff-directory", "/directory", "/staff/"), "text:staff_contact_terms": says(*DETECTION), "table:contact_headers": n("header_hits") >= 2,
        "block:sidebar_staff": n("sidebar_staff_hits") >= 1, "block:contact_card": n("contact_card_hits") >= 1, "block:inline_staff": n("inline_staff_hits") >= 1, "block:labeled_staff": n("labeled_staff_hits") >= 1,
        "block:profile_repeat": n("profile_block_hits") >= 2, "section:department_heading": n("department_section_hits") >= 1, "text:key_value_fields": n("key_value_hits") >= 3, "text:read_more": n("read_more_hits") >= 1,
        "context:department_breadcrumb": n("breadcrumb_department_hits") >= 1, "url:contact_hub": has_any(u, "contact_us", "directory_of_services"), "text:contact_us": says("contact us"), "text:directory_of_services": says("directory of services"),
    }
    signals = F.filter(F.array(*[F.when(test, name) for name, test in sorted(seen.items())]), lambda x: x.isNotNull())
    rows = rows.withColumns({"page_class": final, "signals": signals, "page_kind": F.when(n("matched"), "staff_directory_or_profile").otherwise("unknown")})
    score = routes.by_class(F.col("page_class"), routes.CLASS_WEIGHT).alias("page_priority_score")
    return rows.select("page_id", "page_kind", "source_type", "page_class", score, "signals", *COUNTERS)


# ---- contact rows that are text of documents

# Words of documents, names that documents gave, what kinds of rows are made of, how far text is read.
DOCUMENT_WORDS = ("permit", "regulation", "code", "application", "certificate", "affidavit", "cover page")
DOCUMENT_NAMES = ("development permit", "adopted march", "cover page", "international code council")
CARDS, ROWS = ("contact_card", "profile_block", "single_profile_page", "department_contact_block", "reconstructed_contact_block"), ("table_directory", "sidebar_staff", "inline_staff_list")
BLOB, LONG = 500, 120


def non_contacts(rows: DataFrame, kind: str = "source_kind") -> DataFrame:
    """rows (name, title, department, email, phone, phone_ext, source_context, kind; optionally lines, an array that is read
    instead of the context) with block_type and non_contact: whether a row is text of a document and no contact."""
    source = F.lower(F.coalesce(F.nullif(clean(kind), F.lit("")), F.lit("unknown")))
    fields = F.concat_ws(" ", *[F.nullif(clean(f), F.lit("")) for f in ("source_context", "name", "title", "department")])
    whole = F.coalesce(F.nullif(F.array_join(F.slice(F.filter(F.transform("lines", clean), lambda x: x != ""), 1, 16), " "), F.lit("")), fields) if "lines" in rows.columns else fields
    structured = F.concat_ws("", F.trim("email"), F.trim("phone"), F.trim("phone_ext"), F.nullif(clean("title"), F.lit(""))) != ""

    def judged(x: Column) -> Column:
        said, name, kind = x["text"], x["name"], x["kind"]
        odd_name = F.lower(name).isin(*DOCUMENT_NAMES) | ((name != "") & ~name.contains(" ") & ~name.rlike(r"^[A-Z][a-zA-Z'`.-]{1,40}$"))
        words = has_any(F.lower(said), *DOCUMENT_WORDS)
        weak = (kind == "department_section") | ((kind == "labeled_staff") & ~x["structured"])
        dense = (F.length(said) > LONG) | (F.regexp_count(said, F.lit(r"[.!?](?:\s|$)")) >= 2) | (F.regexp_count(said, F.lit(":")) >= 2)
        made_of = chain((kind.isin(*CARDS), "contact_card"), (kind.isin(*ROWS) | ((kind == "labeled_staff") & x["structured"]), "staff_row"), (kind.isin("labeled_staff", "department_section"), "department_content"), default="unknown")
        return F.struct((odd_name | (weak & (dense | words)) | (words & dense)).alias("non_contact"), F.when(words | odd_name, "document_content").otherwise(made_of).alias("block_type"))

    read = F.struct(F.substring(clean(whole), 1, BLOB).alias("text"), clean("name").alias("name"), source.alias("kind"), structured.alias("structured"))
    names = [x for x in rows.columns if x not in ("non_contact", "block_type")]
    return rows.select(*names, let(read, judged).alias("_judged")).select(*names, "_judged.non_contact", "_judged.block_type")
