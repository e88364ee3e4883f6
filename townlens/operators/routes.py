"""The links of pages, made absolute and labelled, and which of them lead to staff and departments, in the order to visit them.

Column expressions over one row an anchor; the first anchor of each target and the order within a page are one exchange by page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.functions import urls
from townlens.functions.people import clean
from townlens.functions.text import c, chain, has_any, low

# What links to staff and departments say, the classes of pages with their order and weights.
HARVEST = ("staff", "directory", "contact", "employee", "official", "department", "town hall", "city hall", "administration", "read more", "profile")
ROLE_TERMS = ("assessor", "tax collector", "collector of revenue", "town clerk", "city clerk", "building", "zoning", "inspection", "planning", "land use", "finance", "accounting", "treasurer", "town manager", "town administrator", "first selectman", "selectmen", "mayor")
CLASS_ORDER = {"staff_directory": 0, "department_page": 1, "contact_hub": 2, "generic": 3}
CLASS_SCORE = {"staff_directory": 120, "department_page": 85, "contact_hub": 45, "generic": 15}
CLASS_WEIGHT = {"staff_directory": 1.0, "department_page": 0.75, "contact_hub": 0.4, "generic": 0.2}
ORIGIN_BOOST = {"priority_path": 25, "harvested_link": 15, "department_index_discovery": 12, "direct_path": 10, "section_enumeration": 8, "section_root": 6, "discovered_link": 5}
MOST = 35
ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"[^"]+"|'[^']+'|[^\s>"']+)[^>]*>.*?</a>"""
HREF = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]+)"|'([^']+)'|([^\s>"']+))"""
#: Character references that anchors use, the ampersand last.
REFERENCES = (("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def plain(x: Column) -> Column:
    """Markup taken out, the common character references decoded, one space between words."""
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    for name, sign in REFERENCES:
        x = F.replace(x, F.lit(name), F.lit(sign))
    return clean(x)


def anchors(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, base, place, href, label, url): every anchor of a page in order; url is the absolute, normalised target, null
    where there is none on the web. A null page has no anchors."""
    found = F.posexplode(F.regexp_extract_all(F.coalesce(pages[html], F.lit("")), F.lit(ANCHOR), F.lit(0))).alias("place", "anchor")
    rows = pages.select(pages[id_col].alias("page_id"), pages[url].alias("base"), found)
    part = lambda i: F.regexp_extract("anchor", HREF, i)
    href = F.replace(F.coalesce(*[F.nullif(part(i), F.lit("")) for i in (1, 2)], part(3)), F.lit("&amp;"), F.lit("&"))
    rows = rows.select("page_id", "base", "place", href.alias("href"), plain(F.regexp_replace("anchor", r"(?is)^<a\b[^>]*>|</a>$", "")).alias("label"))
    return rows.withColumn("url", urls.normalize(F.col("href"), F.col("base")))


def source_kind(url: Column, label: Column) -> Column:
    """What a link seems to lead to, from its url and label."""
    said = F.lower(F.concat_ws(" ", url, label))
    has = lambda *words: has_any(said, *words)
    return chain(
        (has("read more", "profile"), "single_profile_page"), (has("directory_of_services"), "directory_of_services"), (has("departments/index"), "department_index_page"),
        (has("staff_directory.php"), "staff_directory_php"), (has("staff_directory_.php"), "staff_directory_underscore_php"), (has("staff-directory"), "staff_directory_path"),
        (has("directory"), "directory_path"), (has("contact_us"), "contact_hub_path"), (has("contact"), "contact_path"), default="unknown",
    )


def page_class(url: Column | str, kind: Column | str, label: Column | str, text: Column | None = None) -> Column:
    """staff_directory, department_page, contact_hub or generic, from a url, what it seems to be, its label and its text."""
    u, k, t = low(url), low(kind), F.lit("") if text is None else F.lower(clean(text))
    said = F.concat_ws(" ", u, t, F.lower(clean(label)), k)
    crumbs = t.contains("breadcrumb") & t.contains("departments")
    return chain(
        (has_any(said, "staff_directory", "staff-directory", "staff contacts", "staff directory"), "staff_directory"),
        (has_any(u, "/departments/", "/departments/index") | k.contains("department_page") | crumbs, "department_page"),
        (has_any(said, "contact_us", "directory_of_services", "/contact", "contact us", "services"), "contact_hub"),
        default="generic",
    )


def by_class(kind: Column, table: dict[str, float]) -> Column:
    return chain(*[(kind == k, v) for k, v in table.items()], default=table["generic"])


def priority(kind: Column, origin: str, url: Column, label: Column, source: Column) -> Column:
    said = F.concat_ws(" ", low(url), low(label), low(source))
    terms = F.when(has_any(said, *ROLE_TERMS), 10).otherwise(0)
    return by_class(kind, CLASS_SCORE) + F.lit(ORIGIN_BOOST.get(origin, 0)) + F.when(kind == "staff_directory", 6).otherwise(0) + terms


def first_targets(links: DataFrame) -> DataFrame:
    """The first anchor of each target of a page."""
    once = Window.partitionBy("page_id", "url").orderBy("place")
    # a row each: the filter does not go below it, where it would resolve every reference a second time
    links = links.select(*[x for x in links.columns if x != "url"], F.explode(F.array("url")).alias("url"))
    return links.filter(F.col("url").isNotNull()).withColumn("nth", F.row_number().over(once)).filter("nth = 1").drop("nth")


def ordered(rows: DataFrame, most: int) -> DataFrame:
    rank = Window.partitionBy("page_id").orderBy(by_class(c("page_class"), CLASS_ORDER), F.col("score").desc(), "place")
    fields = ("page_id", "url", "label", "source_kind", "page_class", "score")
    return rows.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= most).select(*fields, "rank")


def profile_links(pages: DataFrame, most: int = MOST, **columns: str) -> DataFrame:
    """Links of each page that speak of staff, best first: page_id, url, label, source_kind, page_class, score, rank."""
    rows = first_targets(anchors(pages, **columns))
    rows = rows.filter(has_any(F.lower(F.concat_ws(" ", "url", "label")), *HARVEST)).withColumn("source_kind", source_kind(c("url"), c("label")))
    rows = rows.withColumn("page_class", page_class("url", "source_kind", "label"))
    return ordered(rows.withColumn("score", priority(c("page_class"), "discovered_link", c("url"), c("label"), c("source_kind"))), most)


def department_links(pages: DataFrame, most: int = MOST, **columns: str) -> DataFrame:
    """Links of each page that name a key role or lie under departments or government, best first."""
    said = F.lower(F.concat_ws(" ", "url", "label"))
    rows = first_targets(anchors(pages, **columns)).withColumn("role", has_any(said, *ROLE_TERMS))
    rows = rows.filter(F.col("role") | has_any(F.lower("url"), "/departments/", "/government/")).withColumn("source_kind", source_kind(c("url"), c("label")))
    kind = page_class("url", "source_kind", "label")
    rows = rows.withColumn("page_class", F.when(kind == "generic", "department_page").otherwise(kind))
    score = priority(c("page_class"), "department_index_discovery", c("url"), c("label"), c("source_kind")) + F.when(F.col("role"), 8).otherwise(0)
    return ordered(rows.withColumn("score", score), most)
