"""Contacts put together from the scattered text nodes of staff blocks.

`staff_blocks` finds the blocks of a page and their text nodes in document order: the only step that needs the document, one
page at a time over Arrow, every block with every line. All that follows is column expressions, the department's over a page,
the others over one row a block: digits that nodes split are joined, then name, title, mail and phone are taken from where each stands first (heading, links, lines, joined text), then the block
is accepted or rejected with its reason. No exchange, no group."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.functions import people, urls
from townlens.functions.dom import Element, parse
from townlens.functions.people import clean
from townlens.functions.text import chain, has_any, let
from townlens.operators import extract

#: The marks of staff blocks, of blocks that are never staff, and the confidence of a reconstructed contact.
STAFF = re.compile("(?i)staff|contact|profile|employee")
STAFF_TAGS = ("div", "li", "article", "section")
EXCLUDED_CLASSES, EXCLUDED_ID = ("footer-links-box", "rz-btns-container", "resource-link"), "hours-wrap"
STRUCTURAL_START = re.compile(r"(?:office hours|resources|related links)\b")
KIND, CONFIDENCE = "reconstructed_contact_block", 0.86
#: Blocks that share a row with one copy of their page's context, and pages and blocks that go to Spark at once: all blocks go.
TOGETHER, PAGES, SENT = 200, 100, 1000
TEXT = pa.list_(pa.string())
BLOCK = {"block_no": pa.int32(), "lines": TEXT, "heading": pa.string(), "heading_title": pa.string(), "mail": pa.string(), "tel": pa.string(), "has_mailto": pa.bool_(), "has_tel": pa.bool_()}
CONTEXT = {"crumbs": TEXT, "h1": pa.string(), "page_title": pa.string(), "headings": TEXT, "nav": TEXT}
SQL = {pa.int32(): "int", TEXT: "array<string>", pa.string(): "string", pa.bool_(): "boolean"}


def strings(x: Element) -> list[str]:
    """Text nodes in document order, with single spaces, without empty ones."""
    out, todo = [], [x]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            out.append(" ".join(at.split()))
        elif at.tag not in ("script", "style"):
            todo.extend(reversed(at.kids))
    return [s for s in out if s]


def structural(x: Element, lines: list[str]) -> bool:
    """Whether an element, whose text nodes are lines, stands in a footer or is a part that is never staff."""
    up = x.parent
    while up is not None:
        if up.tag == "footer":
            return True
        up = up.parent
    classes = x.attrs.get("class", "").lower()
    if any(k in classes for k in EXCLUDED_CLASSES) or x.attrs.get("id", "").lower() == EXCLUDED_ID:
        return True
    return STRUCTURAL_START.match(" ".join(lines).lower()) is not None


def context_of(root: Element) -> dict:
    """What a page says of its department: breadcrumbs, first heading, title, section headings, labels of side menus."""
    crumbs: dict[str, None] = {}
    nav: dict[str, None] = {}
    headings: dict[str, None] = {}
    h1 = title = None
    for x in root.walk():
        text = lambda: " ".join(strings(x))  # noqa: B023, E731
        name, mark = x.attrs.get("class", "").lower(), x.attrs.get("id", "").lower()
        if x.tag == "h1" and h1 is None:
            h1 = text()
        elif x.tag == "title" and title is None:
            title = text()
        if x.tag in ("nav", "ul", "ol", "div") and "breadcrumb" in name and "breadcrumb" in mark:
            crumbs |= dict.fromkeys(p.strip() for p in re.split(r"\s*[>/|»]+\s*", text()) if p.strip())
        if x.tag in ("aside", "nav", "div", "ul") and ("left" in mark or "sidebar" in mark):
            labels = [" ".join(strings(a)) for a in x.all("a")]
            nav |= dict.fromkeys(t for t in labels if t and t.lower() not in ("home", "government", "departments"))
        if x.tag in ("h2", "h3", "h4"):
            low = text().lower()
            if low and any(k in low for k in people.DEPARTMENT_HINTS) and low not in people.ACTION_TEXTS and not any(k in low for k in people.STRUCTURAL_TEXTS):
                headings[text()] = None
    return {"crumbs": list(crumbs), "h1": h1, "page_title": title, "headings": list(headings), "nav": list(nav)}


def blocks_of(html: str | None) -> list[dict]:
    """All staff blocks of a page: those of the staff sidebar first, then blocks of a telling class, in document order."""
    root = parse(html)
    every = root.walk()
    side = [x for a in every if a.tag == "aside" and a.attrs.get("id") == "staff-dr" for x in a.walk() if x is not a and "staff" in x.attrs.get("class", "").split()]
    marked = [x for x in every if x.tag in STAFF_TAGS and STAFF.search(x.attrs.get("class", ""))]
    out: list[dict] = []
    context = None
    for x in {id(x): x for x in side + marked}.values():
        lines = strings(x)
        if not lines or structural(x, lines):
            continue
        hrefs = [a.attrs["href"] for a in x.all("a") if "href" in a.attrs]
        mails, tels = ([h for h in hrefs if h.lower().startswith(k)] for k in ("mailto:", "tel:"))
        text, head = " | ".join(lines), next((h for t in ("h4", "h3", "h2") if (h := x.first(t))), None)
        digits = re.search("[0-9]", text) is not None
        signs = bool(mails or tels or EMAIL.search(text) or (digits and re.search(extract.PHONE, text)))
        if not signs and not (head and digits):
            continue
        span = head.first("span") if head else None
        name = " ".join(s for k in head.kids if not (isinstance(k, Element) and k.tag == "span") for s in ([k.strip()] if isinstance(k, str) else strings(k))) if head else None
        context = context or context_of(root)
        out.append({"block_no": len(out), "lines": lines, "heading": name, "heading_title": " ".join(strings(span)) if span else None, "mail": mails[0] if mails else None, "tel": tels[0] if tels else None, "has_mailto": bool(mails), "has_tel": bool(tels), **context})
    return out


EMAIL = re.compile(extract.EMAIL)


def staff_blocks(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row a staff block: page_id, url, the department that its page names and the fields of BLOCK. Pages without blocks, or
    null, give none."""
    source = pages.select(pages[id_col].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"))
    block = pa.struct(list(BLOCK.items()))

    def batch(rows, kind):
        columns = [pa.array([x[0] for x in rows], kind), pa.array([x[1] for x in rows], pa.string())]
        columns += [pa.array([x[2][0][f] for x in rows], k) for f, k in CONTEXT.items()]
        return pa.RecordBatch.from_arrays([*columns, pa.array([[{f: r[f] for f in BLOCK} for r in x[2]] for x in rows], pa.list_(block))], ["page_id", "url", *CONTEXT, "blocks"])

    def run(batches):
        for b in batches:
            kind = b.column("page_id").type
            for at in range(0, b.num_rows, PAGES):
                some, rows, held = b.slice(at, PAGES), [], 0
                for p, u, h in zip(*(some.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                    found = blocks_of(h)
                    for i in range(0, len(found), TOGETHER):
                        rows.append((p, u, found[i : i + TOGETHER]))
                        held += len(rows[-1][2])
                        if held >= SENT:
                            yield batch(rows, kind)
                            rows, held = [], 0
                yield batch(rows, kind)

    kind = source.schema["page_id"].dataType.simpleString()
    fields = ", ".join(f"{f} {SQL[k]}" for f, k in CONTEXT.items()) + ", blocks array<struct<" + ", ".join(f"{f}: {SQL[k]}" for f, k in BLOCK.items()) + ">>"
    found = source.mapInArrow(run, f"page_id {kind}, url string, {fields}")
    department = inferred_department(*map(F.col, CONTEXT), F.col("url")).alias("department")
    return found.select("page_id", "url", department, "blocks").select("page_id", "url", "department", F.inline("blocks"))


URL_WORDS = ("building", "assessor", "clerk", "finance", "planning", "zoning", "police", "fire")
URL_PAGES = ("index.php", "staff_directory.php", "staff_directory_.php", "staff-directory", "directory")


def url_department(url: Column | str) -> Column:
    """The department that the path of a url names: what follows `departments`, else the last telling segment."""

    def named(segments: Column) -> Column:
        at = F.array_position(F.transform(segments, F.lower), "departments").cast("int")
        telling = F.filter(F.reverse(segments), lambda s: ~F.lower(s).isin(*URL_PAGES) & has_any(F.lower(s), "department", *URL_WORDS))
        after = F.when(at > 0, F.get(segments, at))
        return let(F.coalesce(F.when(~F.lower(after).isin(*URL_PAGES), after), F.get(telling, F.lit(0))), people.department_label)

    return let(F.filter(F.split(urls.path(url), "/"), lambda s: s != ""), named)


def inferred_department(crumbs: Column, h1: Column, title: Column, headings: Column, nav: Column, url: Column) -> Column:
    """The first of six sources that names a department: breadcrumbs (those after `Departments`, then the last), the main
    heading, the title, section headings, the url, labels of side menus."""
    low = F.transform(crumbs, F.lower)
    at = F.array_position(low, "departments")
    after = F.when(at > 0, F.slice(crumbs, at.cast("int") + 1, F.size(crumbs))).otherwise(F.slice(crumbs, F.lit(1), F.lit(0)))
    last = F.slice(crumbs, F.greatest(F.size(crumbs), F.lit(1)), F.lit(1))
    trail = F.filter(F.concat(after, last), lambda x: ~F.lower(x).isin("home", "government", "departments"))
    none = F.array().cast("array<string>")
    candidates = F.concat(F.coalesce(trail, none), F.array(h1, title), F.coalesce(headings, none), F.array(url_department(url)), F.coalesce(nav, none))
    return F.get(F.filter(F.transform(candidates, people.department_label), lambda x: x.isNotNull()), F.lit(0))


#: A phone and all text behind the phone before it, so that what stands right before a phone can be seen. \G holds the search to
#: one pass: a text without a (further) phone would be gone through anew from each of its characters.
BEFORE_PHONE = rf"(?is)\G(.*?)({extract.PHONE.removeprefix('(?i)')})"


def spoken(text: Column, hint: Column) -> Column:
    """phone and ext: the first phone in text (digits joined) that does not follow `fax` within twelve characters, else the first
    of all; and its extension, else the hint, as at most six digits."""

    def first(t: Column) -> Column:
        part = lambda i: F.regexp_extract_all(t, F.lit(BEFORE_PHONE), F.lit(i))
        found = F.zip_with(part(1), part(2), lambda before, phone: F.struct(F.lower(F.right(before, F.lit(12))).contains("fax").alias("fax"), phone.alias("phone")))
        return let(found, lambda all_of: F.get(F.concat(F.filter(all_of, lambda x: ~x["fax"]), all_of), F.lit(0)))["phone"]

    def parts(x: Column) -> Column:
        digits = lambda i: F.regexp_extract(x["phone"], extract.PHONE, i)
        own = F.when(x["phone"].isNotNull(), F.nullif(digits(4), F.lit("")))
        extension = F.substring(F.regexp_replace(F.coalesce(own, x["hint"]), "[^0-9]", ""), 1, 6)
        return F.struct(F.when(x["phone"].isNotNull(), F.concat(digits(1), digits(2), digits(3))).alias("phone"), F.nullif(extension, F.lit("")).alias("ext"))

    return let(F.struct(let(text, first).alias("phone"), hint.alias("hint")), parts)


def phone_and_extension(text: Column, hint: Column) -> tuple[Column, Column]:
    """The parts of spoken(), each computed for itself."""
    both = spoken(text, hint)
    return both["phone"], both["ext"]


def first_phone(text: Column) -> Column:
    return F.get(extract.phones(text), F.lit(0))


def reconstruct(blocks: DataFrame) -> DataFrame:
    """Every block with what was put together: name, title, department, email, phone, phone_ext, source_context, joins (places
    where split digits were joined), accepted and, where not, rejection_reason: already_structured_sidebar (links hold all and
    nothing was split), vacancy_name, missing_name, invalid_person_name, missing_supporting_signal."""
    c = F.col
    one = F.array_join("lines", " ")
    rows = blocks.withColumns({"joins": people.joins_of(one), "text": people.joined_digits(one)})
    linked = first_phone(F.try_url_decode(F.replace(F.regexp_replace("tel", "(?i)^tel:", ""), F.lit("+"), F.lit("%2B"))))
    mailed = F.get(extract.emails(F.try_url_decode(F.replace(F.regexp_replace("mail", "(?i)^mailto:", ""), F.lit("+"), F.lit("%2B")))), F.lit(0))
    rows = rows.withColumns({"linked": linked, "name": F.coalesce(F.nullif(people.joined_digits("heading"), F.lit("")), people.person_in("text"))})
    bare = lambda x: F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))
    line_title = F.get(F.filter(F.slice("lines", 1, 5), lambda x: people.is_title(x) & ((bare(x) != bare(c("name"))) | (bare(c("name")) == ""))), F.lit(0))
    whole = F.concat_ws(" | ", c("linked.phone"), F.nullif("text", F.lit("")), F.concat(F.lit("x"), c("linked.phone_ext")))
    rows = rows.withColumns({"title": F.coalesce(F.nullif(people.joined_digits("heading_title"), F.lit("")), line_title), "email": F.coalesce(mailed, F.get(extract.emails("text"), F.lit(0))), "whole": people.joined_digits(whole)})
    rows = rows.withColumn("spoken", spoken(c("whole"), c("linked.phone_ext")))
    rows = rows.withColumns({"phone": F.coalesce("spoken.phone", "linked.phone"), "phone_ext": c("spoken.ext")})
    reason = chain(
        ((c("joins") == 0) & c("has_tel") & c("has_mailto"), "already_structured_sidebar"),
        (people.is_vacancy("name"), "vacancy_name"),
        (c("name").isNull(), "missing_name"),
        (~people.accepts_name(c("name"), c("title")), "invalid_person_name"),
        (F.coalesce("title", "email", "phone").isNull(), "missing_supporting_signal"),
    )
    fields = ("page_id", "url", "block_no", "lines", "name", "title", "department", "email", "phone", "phone_ext", "joins")
    return rows.select(*fields, F.substring("text", 1, 240).alias("source_context"), reason.isNull().alias("accepted"), reason.alias("rejection_reason"))


def reconstructed_contacts(pages: DataFrame, **columns: str) -> DataFrame:
    """The accepted blocks of pages as contact rows of kind reconstructed_contact_block.

    Rejected rows go by an empty array, not by a filter, which would be pushed down into the rules and repeat them."""
    rows = reconstruct(staff_blocks(pages, **columns))
    fields = [c for c in rows.columns if c not in ("accepted", "rejection_reason", "lines")]
    kept = rows.select(F.inline(F.when(F.col("accepted"), F.array(F.struct(*fields)))))
    return kept.withColumns({"email_type": extract.email_type("email"), "source_kind": F.lit(KIND), "confidence": F.lit(CONFIDENCE)})


def rejection_counts(blocks: DataFrame) -> DataFrame:
    """(reason, blocks, joins) over reconstructed blocks, accepted ones as `accepted`."""
    reason = F.coalesce("rejection_reason", F.lit("accepted")).alias("reason")
    return blocks.groupBy(reason).agg(F.count("*").alias("blocks"), F.sum("joins").cast("long").alias("joins"))
