"""Staff pages read whole: structural parts go first, then an outline of sections, profiles and fields is read by rules.

`outlines` is the one step that needs the document: it numbers the elements of a page in document order with the interval that
each one spans, drops the intervals of footers, hours and link boxes (`pruned`), and returns plain facts: lines, department
sections with the siblings under their headings, and small blocks that may be profiles. The readers are column expressions
over those facts. `assembled` puts the rows of all readers into the order that their kind of page asks for, takes out text of
documents, and merges rows of one person, the first reader first."""

from __future__ import annotations

import re
from html import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions import people
from townlens.functions.dom import VOID, Element, parse
from townlens.functions.people import clean
from townlens.functions.text import c, has_any, let, low
from townlens.operators import extract, fragments, merge, page_contacts, page_evidence
from townlens.sources.shared import settled

# Parts of pages that hold no contacts, block tags, sizes and marks of profiles, sizes of sections, confidences.
DROPPED_CLASSES, DROPPED_ID = ("footer-links-box", "rz-btns-container", "resource-link"), "hours-wrap"
TEXT_TAGS = ("section", "div", "aside", "nav", "ul", "ol", "article")
PROFILE_TAGS, PROFILE_SIZE = ("article", "section", "li", "div"), (24, 420)
PROFILE_MARKS = re.compile("staff|profile|employee|team|directory|person|card")
SECTION_HEADS, BREAKS_SECTION = ("h2", "h3", "h4", "strong"), ("h1", "h2", "h3", "h4", "strong")
SECTION_LINE = 1200
FIELD = r"(?i)^\s*(name|title|position|profession|department|office|phone|office phone|email|location)\s*[:\-]\s*(.+)$"
CONFIDENCE = {"profile_block": 0.79, "department_section": 0.74, "single_profile_page": 0.78}
#: The order of the readers on pages of departments and on others: where two rows are one person, the earlier reader's words stay.
ON_DEPARTMENTS = ("reconstructed_contact_block", "sidebar_staff", "table", "contact_card", "inline_staff_list", "labeled_staff", "profile_block", "department_section", "single_profile_page")
ELSEWHERE = ("reconstructed_contact_block", "table", "contact_card", "profile_block", "inline_staff_list", "labeled_staff", "department_section", "single_profile_page", "sidebar_staff")


def intervals(root: Element) -> list[tuple[Element, int, int]]:
    """Every element with its number in document order and the number after its last descendant."""
    order = root.walk()
    place = {id(x): i for i, x in enumerate(order)}
    end = list(range(1, len(order) + 1))
    for x in reversed(order):
        if x.parent is not None and id(x.parent) in place:
            p = place[id(x.parent)]
            end[p] = max(end[p], end[place[id(x)]])
    return [(x, i, e) for i, (x, e) in enumerate(zip(order, end))]


def opening(x: Element, gone: set[int], size: int = 24) -> str:
    """The first characters of what is left of an element's text."""
    out, todo = "", list(reversed(x.kids))
    while todo and len(out) < size:
        at = todo.pop()
        if isinstance(at, str):
            out = f"{out} {' '.join(at.split())}".strip()
        elif id(at) not in gone and at.tag not in ("script", "style"):
            todo.extend(reversed(at.kids))
    return out.lower()


def pruned(root: Element) -> dict[str, int]:
    """Takes structural parts out of a document; how many of each kind went. What lies in a part that an earlier rule took does
    not count again; of parts that begin with the words of a link box or of opening hours, the outer one goes and counts."""
    spans = intervals(root)
    gone: set[int] = set()
    counts = {"footer_blocks": 0, "hours_blocks": 0, "structural_blocks": 0}

    def drop(some: list[tuple[int, int]], kind: str | None) -> None:
        for i, e in [s for s in some if id(spans[s[0]][0]) not in gone]:
            counts["structural_blocks"] += 1
            if kind:
                counts[kind] += 1
            gone.update(id(spans[k][0]) for k in range(i, e))

    marked = [(x, i, e) for x, i, e in spans if x.attrs]
    has_class = lambda name: [(i, e) for x, i, e in marked if name in x.attrs.get("class", "").split()]
    drop([(i, e) for x, i, e in spans if x.tag == "footer"], "footer_blocks")
    drop(has_class(DROPPED_CLASSES[0]), None)
    drop(has_class(DROPPED_CLASSES[1]), None)
    drop([(i, e) for x, i, e in marked if x.attrs.get("id") == DROPPED_ID], "hours_blocks")
    drop(has_class(DROPPED_CLASSES[2]), None)
    drop([(i, e) for x, i, e in spans if x.tag == "script" and "rz.module" in "".join(k for k in x.kids if isinstance(k, str)).lower()], None)
    for x, i, e in spans:
        if x.tag in TEXT_TAGS and id(x) not in gone and (m := STARTS.match(opening(x, gone))):
            drop([(i, e)], "hours_blocks" if m[0] == "office hours" else None)
    for x, _, _ in spans if gone else ():
        if id(x) not in gone:
            x.kids = [k for k in x.kids if isinstance(k, str) or id(k) not in gone]
    return counts


STARTS = re.compile(r"(?:office hours|resources|related links)\b")


def markup(x: Element) -> str:
    """A document as text again."""
    out: list[str] = []
    todo: list[Element | str | tuple[str]] = list(reversed(x.kids))
    while todo:
        at = todo.pop()
        if isinstance(at, tuple):
            out.append(at[0])
        elif isinstance(at, str):
            out.append(escape(at, quote=False))
        else:
            out.append(f"<{at.tag}" + "".join(f' {k}="{escape(v)}"' for k, v in at.attrs.items()) + ">")
            if at.tag in ("script", "style"):
                out += [k for k in at.kids if isinstance(k, str)] + [f"</{at.tag}>"]
            elif at.tag not in VOID:
                todo.append((f"</{at.tag}>",))
                todo.extend(reversed(at.kids))
    return "".join(out)


def sanitized(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, html without structural parts, and how many went: footer_blocks, hours_blocks, structural_blocks (all). A
    null page stays null and counts nothing."""
    source = pages.select(pages[id_col].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 100):
                some = b.slice(at, 100)
                out, counts = [], []
                for h in some.column("html").to_pylist():
                    root = parse(h)
                    counts.append(pruned(root))
                    out.append(None if h is None else markup(root))
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(out, pa.string()), *[pa.array([x[k] for x in counts], pa.int32()) for k in COUNTED]], ["page_id", "url", "html", *COUNTED])

    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, url string, html string, " + ", ".join(f"{k} int" for k in COUNTED))


COUNTED = ("footer_blocks", "hours_blocks", "structural_blocks")
SECTION = pa.struct([("heading", pa.string()), ("lines", pa.list_(pa.string()))])
PROFILE = pa.struct([("text", pa.string()), ("hrefs", pa.list_(pa.string())), ("headings", pa.list_(pa.string())), ("marked", pa.bool_()), ("near", pa.string())])
OUTLINE = {"lines": pa.list_(pa.string()), "sections": pa.list_(SECTION), "profiles": pa.list_(PROFILE), "title_heading": pa.string(), "crumbs": pa.list_(pa.string()), "h1": pa.string(), "page_title": pa.string(), "headings": pa.list_(pa.string()), "nav": pa.list_(pa.string())}
OUTLINE_SQL = "lines array<string>, sections array<struct<heading:string,lines:array<string>>>, profiles array<struct<text:string,hrefs:array<string>,headings:array<string>,marked:boolean,near:string>>, title_heading string, crumbs array<string>, h1 string, page_title string, headings array<string>, nav array<string>"


def outline_of(html: str | None) -> dict:
    """Plain facts of a page without its structural parts."""
    root = parse(html)
    pruned(root)
    spans = intervals(root)
    text = lambda x: " ".join(fragments.strings(x))
    lines = [t for s in _raw_strings(root) for line in s.splitlines() if (t := " ".join(line.split()))]
    sections, profiles, near, tables, beside = [], [], None, [], {}
    for x, i, e in spans:
        if x.tag == "table":
            tables.append((i, e))
        if x.tag in SECTION_HEADS and any(k in text(x).lower() for k in people.DEPARTMENT_HINTS):
            if id(x.parent) not in beside:
                kids = [k for k in x.parent.kids if isinstance(k, Element)]
                beside[id(x.parent)] = kids, {id(k): n for n, k in enumerate(kids)}
            kids, at = beside[id(x.parent)]
            under = []
            for n in range(at[id(x)] + 1, len(kids)):
                k = kids[n]
                if k.tag in BREAKS_SECTION:
                    break
                if 0 < len(t := text(k)) <= SECTION_LINE:
                    under.append(t)
            if under:
                sections.append({"heading": text(x), "lines": under})
        if x.tag in PROFILE_TAGS and not any(a < i < z for a, z in tables) and PROFILE_SIZE[0] <= len(t := text(x)) <= PROFILE_SIZE[1]:
            marks = f"{x.attrs.get('class', '')} {x.attrs.get('id', '')}".lower()
            hrefs = [a.attrs["href"] for a in x.all("a") if "href" in a.attrs]
            profiles.append({"text": t, "hrefs": hrefs, "headings": [text(h) for h in x.all(*BREAKS_SECTION)], "marked": PROFILE_MARKS.search(marks) is not None, "near": near})
        if x.tag in BREAKS_SECTION:
            near = text(x)
    head = next((x for x, _, _ in spans if x.tag in ("h1", "h2")), None)
    return {"lines": lines, "sections": sections, "profiles": profiles, "title_heading": text(head) if head else None, **fragments.context_of(root)}


def _raw_strings(x: Element) -> list[str]:
    out, todo = [], [x]
    while todo:
        at = todo.pop()
        if isinstance(at, str):
            out.append(at)
        elif at.tag not in ("script", "style", "noscript"):
            todo.extend(reversed(at.kids))
    return out


def outlines(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url and the facts of OUTLINE of every page."""
    source = pages.select(pages[id_col].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 100):
                some = b.slice(at, 100)
                found = [outline_of(h) for h in some.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), *[pa.array([x[f] for x in found], k) for f, k in OUTLINE.items()]], ["page_id", "url", *OUTLINE])

    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, url string, {OUTLINE_SQL}")


# ---- readers


def named_in(lines: Column) -> Column:
    """The first of the first four lines that is a person, or names one."""
    names = F.transform(F.slice(lines, 1, 4), lambda x: let(people.joined_digits(x), lambda t: F.when(people.is_person(t), t).otherwise(people.person_in(t))))
    return F.get(F.filter(names, lambda x: x.isNotNull()), F.lit(0))


def titled_in(lines: Column, name: Column) -> Column:
    bare = lambda x: F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))
    return F.get(F.filter(F.slice(lines, 1, 5), lambda x: people.is_title(x) & ((bare(x) != bare(name)) | (bare(name) == ""))), F.lit(0))


def department_in(lines: Column) -> Column:
    return F.get(F.filter(F.slice(lines, 1, 5), people.is_department), F.lit(0))


def useful(lines: Column) -> Column:
    return F.filter(F.transform(lines, clean), lambda x: (x != "") & ~F.lower(x).isin(*people.ACTION_TEXTS))


def contact(kind: str, block: Column, name: Column, title: Column, department: Column, emails: Column, phones: Column, context: Column) -> Column:
    """A contact row of a reader, null where there is neither mail nor phone."""
    phone = F.get(phones, F.lit(0))
    row = F.struct(F.lit(kind).alias("source_kind"), block.cast("int").alias("block_no"), name.alias("name"), title.alias("title"), department.alias("department"), F.get(F.array_sort(emails), F.lit(0)).alias("email"), phone["phone"].alias("phone"), phone["phone_ext"].alias("phone_ext"), F.substring(context, 1, 240).alias("source_context"), F.lit(CONFIDENCE[kind]).alias("confidence"))
    return F.when((F.size(emails) > 0) | phone.isNotNull(), row)


def mails_of(hrefs: Column) -> Column:
    decoded = F.transform(hrefs, lambda h: F.coalesce(F.try_url_decode(F.replace(F.regexp_replace(h, "(?i)^mailto:", ""), F.lit("+"), F.lit("%2B"))), F.lit("")))
    return F.flatten(F.transform(decoded, extract.emails))


def profile_contact(p: Column, i: Column) -> Column:
    """A small block that is marked as a profile or headed by a person."""
    lines = useful(F.array(p["text"]))
    person = F.get(F.filter(F.transform(p["headings"], people.joined_digits), people.is_person), F.lit(0))
    name = F.coalesce(person, named_in(lines))
    near = F.when(people.is_department(p["near"]), p["near"])
    row = contact("profile_block", i, name, titled_in(lines, name), F.coalesce(department_in(lines), near), F.array_distinct(F.concat(extract.emails(p["text"]), mails_of(p["hrefs"]))), extract.phones(p["text"]), F.array_join(F.slice(lines, 1, 6), " | "))
    return F.when((p["marked"] | person.isNotNull()) & (F.size(lines) > 0), row)


def chunks(lines: Column) -> Column:
    """The lines of a section cut behind each that ends a contact: one with a mail, a phone or a word for either, where one
    stands in the last five lines. Of each contact these five, which are all that it is read from; lines behind the last cut
    belong to none."""
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("now"), F.array().cast("array<array<string>>").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        now = F.concat(F.slice(acc["now"], F.greatest(F.size(acc["now"]) - 3, F.lit(1)), F.lit(4)), F.array(line))
        tail = F.array_join(now, " | ")
        ends = (F.size(extract.emails(line)) > 0) | (F.size(extract.phones(line)) > 0) | has_any(F.lower(line), "read more", "office phone", "email")
        full = ends & ((F.size(extract.emails(tail)) > 0) | (F.size(extract.phones(tail)) > 0))
        return F.struct(F.when(full, none).otherwise(now).alias("now"), F.when(full, F.concat(acc["out"], F.array(now))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(useful(lines), start, step, lambda acc: acc["out"])


def section_contacts(s: Column, i: Column) -> Column:
    def one(chunk: Column) -> Column:
        last = lambda n: F.slice(chunk, F.greatest(F.size(chunk) - (n - 1), F.lit(1)), F.lit(n))
        text = F.array_join(last(5), " | ")
        name = named_in(last(4))
        return contact("department_section", i, name, titled_in(last(4), name), F.coalesce(F.nullif(s["heading"], F.lit("")), department_in(last(4))), extract.emails(text), extract.phones(text), text)

    return F.transform(chunks(s["lines"]), one)


def single_profile(lines: Column, heading: Column) -> Column:
    """`Name: ..., Phone: ...` lines of a page as one contact; the first of each key counts."""
    pairs = F.filter(F.transform(F.filter(lines, lambda x: x.rlike(FIELD)), lambda x: F.struct(F.lower(F.regexp_extract(x, FIELD, 1)).alias("k"), clean(F.regexp_extract(x, FIELD, 2)).alias("v"))), lambda p: p["v"] != "")

    def row(found: Column) -> Column:
        value = lambda k: F.get(F.filter(found, lambda p: p["k"] == k), F.lit(0))["v"]
        keys = F.array_distinct(F.transform(found, lambda p: p["k"]))
        said = F.array_join(F.transform(keys, lambda k: F.concat(k, F.lit(":"), value(k))), "; ")
        named = F.coalesce(value("name"), F.when(people.is_person(heading), heading))
        phones = extract.phones(F.concat_ws(" ", value("phone"), value("office phone")))
        return contact("single_profile_page", F.lit(0), named, F.coalesce(value("title"), value("position"), value("profession")), F.coalesce(value("department"), value("office"), value("location")), extract.emails(value("email")), phones, said)

    return let(pairs, row)


FIELDS = ("name", "title", "department", "email", "phone", "phone_ext", "source_context")


def read_outlines(facts: DataFrame) -> DataFrame:
    """page_id, url, on_department and the rows of the section, profile and single-profile readers."""
    crumbs = F.array_join(F.transform(F.coalesce("crumbs", F.array().cast("array<string>")), F.lower), " ")
    department = fragments.inferred_department(*[c(x) for x in ("crumbs", "h1", "page_title", "headings", "nav", "url")])
    rows = facts.withColumns({"page_department": department, "_crumbs": crumbs})
    rows = rows.withColumn("on_department", low("url").contains("/departments/") | c("page_department").isNotNull() | c("_crumbs").contains("departments"))
    found = F.concat(F.transform("profiles", profile_contact), F.flatten(F.transform("sections", section_contacts)), F.array(single_profile(c("lines"), c("title_heading"))))
    return rows.select("page_id", "url", "page_department", "on_department", F.inline(F.filter(found, lambda x: x.isNotNull())))


def assembled(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The contacts of every page from all readers: a row for each person (name, title, phone), mail or row, with the words of
    the reader that comes first on this kind of page, the highest confidence and the number of sightings. Rows without a
    department take the page's, rows that are text of documents go, and pages on which no reader finds anything are read line
    by line. page_id, source_kind, block_type, the fields, confidence, sightings."""
    kept = settled(sanitized(pages, id_col, url, html), "sanitized")
    facts = settled(outlines(kept), "outlines")
    context = read_outlines(facts)
    blocks = fragments.reconstructed_contacts(kept).select("page_id", "url", "source_kind", "block_no", *FIELDS, "confidence")
    readers = page_contacts.extract_contacts(kept, merged=False).withColumn("block_no", c("row_no"))
    rows = context.select("page_id", "url", "source_kind", "block_no", *FIELDS, "confidence").unionByName(blocks)
    rows = rows.unionByName(readers.select("page_id", "url", "source_kind", "block_no", *FIELDS, "confidence"))
    about = facts.select("page_id", "url", fragments.inferred_department(*[c(x) for x in ("crumbs", "h1", "page_title", "headings", "nav", "url")]).alias("page_department"), F.array_join("crumbs", " ").alias("trail"))
    about = about.select("page_id", "page_department", (low("url").contains("/departments/") | c("page_department").isNotNull() | F.lower("trail").contains("departments")).alias("on_department"))
    return merged(rows, about)


def merged(rows: DataFrame, about: DataFrame) -> DataFrame:
    """Rows of readers of pages (page_id, source_kind, block_no, fields, confidence) and what is known of the pages (page_id,
    page_department, on_department), as one row a contact."""
    ordinal = lambda kinds: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, kinds)), c("source_kind")), F.lit(0)), F.lit(99))
    rows = rows.join(about.dropDuplicates(["page_id"]), "page_id", "left")
    generic = F.min(F.when(c("source_kind") != "generic", 1)).over(Window.partitionBy("page_id"))
    rows = rows.withColumn("_read", generic).filter((c("source_kind") != "generic") | c("_read").isNull()).drop("_read")
    rows = rows.withColumns({"reader": F.when(c("on_department"), ordinal(ON_DEPARTMENTS)).otherwise(ordinal(ELSEWHERE)), "department": F.when((c("source_kind") != "generic") & (clean("department") == ""), c("page_department")).otherwise(c("department"))})
    rows = page_evidence.non_contacts(rows).filter(~c("non_contact"))
    bare = lambda f: F.trim(F.regexp_replace(F.lower(F.coalesce(c(f), F.lit(""))), "[^a-z0-9]+", " "))
    by_mail = F.concat(F.lit("email|"), F.lower(F.trim("email")))
    key = F.when(bare("name") != "", F.concat_ws("|", F.lit("person"), bare("name"), bare("title"), bare("phone"))).when(F.trim(F.coalesce("email", F.lit(""))) != "", by_mail).otherwise(F.concat_ws("|", F.lit("row"), bare("title"), bare("department"), bare("phone")))
    seq = F.struct("reader", F.coalesce("block_no", F.lit(0)).alias("block_no"), F.coalesce("source_context", F.lit("")).alias("said"), F.coalesce("email", F.lit("")).alias("mail"))
    return merge.merge_sightings(rows.withColumns({"contact_key": key, "seq": seq}), ["page_id", "contact_key"], (*FIELDS, "source_kind", "block_type"))
