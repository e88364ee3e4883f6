"""Main text of web pages by wrapper induction.

Pages of one host share one or more templates. Each page becomes a tree of its block elements in one pass; like siblings
(same tag, id and class, digits aside) are one node, an iterator of the template. The trees of a host that differ become its
templates, in rounds: a round takes some of the pages that fit no template yet (those with the smallest hash in as many slots,
SAMPLE at first, then twice as many, up to MOST), and the rounds end when every page of every host fits one. Every page is
then aligned, by simple tree matching, with the template it matches best, and for each line of each page it is
counted in how many of the matching pages the same node has the same line. A line that is the same in CONSTANT of at
least LEAST_PAGES pages is template; all else that an aligned page holds varies, and is content. So no layout and no line is
left out, and all sums are over all pages and do not depend on their order.

Siblings of one node have distinct labels, so the best match of two child lists is a heaviest increasing subsequence:
exact, in n log n, without a table of pairs, and nothing here recurses, however deep a page is.

The text of a page is what varies in its <main>, else in its <article>s, all of them, else in all of it; lines of links
alone are menus. Menus, forms, scripts, notices, adverts and comments are left out by element, role and the words of class
and id, for they may vary too. A page that fits no template of its host, and a page on which nothing would be left, is
read in the same way without a template.

Wrappers are one short row a host. They are broadcast while their measured size is under BROADCAST_BYTES, else pages are
joined by host, where adaptive execution splits a hot host: a page needs its wrapper and no other page.

Defined cases: null or empty html, and pages without text, give an empty text; a null url is a host of its own without a
wrapper; repeated pages each have their row and each count as a page; broken markup is closed as browsers do for the
common cases; white space is what Unicode calls so; columns of other names, whatever they are, are not read.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import defaultdict
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import forget, written

SAMPLE, SAME_TEMPLATE, CONSTANT, LEAST_PAGES = 6, 0.5, 0.9, 3
BROADCAST_BYTES = 16 << 20
#: Counted lines after which a task hands its sums on; changes no result.
FLUSH = 200_000
#: Pages of a host that one round takes at most; the next round takes what fits none of their templates.
MOST = 192

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("html body tbody td tfoot th thead tr caption option optgroup legend".split())
P_BOUNDS = ("td", "th", "table", "caption", "button", "object")
#: A start tag closes the nearest open element of these names, up to the boundary that follows.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)), "tbody": (("tbody", "thead", "tfoot"), ("table",)), "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",))}
#: An end tag of another name does not close elements beyond these.
END_BOUNDS = ("td", "th", "table", "article", "main", "section", "body")
END_FREE = frozenset("table tr tbody thead tfoot article main section body html div".split())
DROPPED = frozenset("head script style noscript template nav footer aside form button select textarea input iframe object svg canvas audio video dialog menu search xmp noembed noframes title".split())
DROPPED_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription share sharing social sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist discussion disqus respond replies related recommended recommendations widget pagination pager skip login signup search toolbar".split())
#: Words that say nothing beside one of those: "related-posts" is left out, "related-work" is not.
BESIDE = frozenset("site page main top bottom left right box bar list links link items item section wrapper wrap container content inner outer area block slot unit panel posts post articles stories block icons buttons button form text message policy global primary secondary desktop mobile sticky js the of and to".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Blocks whose lines are prose even if all of a line is a link.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORD = re.compile(r"[A-Za-z]+")
DIGITS = re.compile(r"\d+")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


@lru_cache(10_000)
def _marked(name: str) -> bool:
    """Whether a class or id calls its element a part beside the text: all of its words do, or say nothing."""
    words = [w for w in WORD.findall(name.lower()) if len(w) > 1]
    return not DROPPED_WORDS.isdisjoint(words) and all(w in DROPPED_WORDS or w in BESIDE for w in words)


@lru_cache(10_000)
def _attributes(tag: str, raw: str) -> tuple[str, bool]:
    """The label of an element and whether its attributes leave it out."""
    found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}
    if not found:
        return tag, False
    named, kind = found.get("id", ""), found.get("class", "")
    drop = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    if tag not in ("html", "body", "main"):
        drop = drop or found.get("role", "").lower() in ROLES
        drop = drop or any(_marked(w) and (tag != "article" or "comment" in w.lower()) for w in (named, *kind.split()))
    return DIGITS.sub("9", f"{tag}#{named}.{kind}") if named or kind else tag, drop


class Page:
    """Block elements in page order (tag, label, parent), and the lines (block, text, characters in links)."""

    __slots__ = ("tags", "labels", "parents", "dropped", "lines")

    def __init__(self, html: str) -> None:
        self.tags, self.labels, self.parents, self.dropped = ["html"], ["html"], [-1], [False]
        self.lines: list[tuple[int, str, int]] = []
        names, blocks, drops = ["html"], [0], [False]  # the open elements
        where: dict[str, list[int]] = defaultdict(list)  # places of the open elements of each name
        where["html"].append(0)
        inline: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal linked
            if inline:
                if text := " ".join("".join(inline).split()):
                    self.lines.append((blocks[-1], text, linked))
                inline.clear()
            linked = 0

        def say(text: str) -> None:
            nonlocal linked
            if not drops[-1]:
                text = unescape(text) if "&" in text else text
                inline.append(text)
                if where["a"]:
                    linked += len(text.strip())

        def close(at: int) -> None:
            if any(blocks[i] != blocks[i - 1] for i in range(at, len(names))):
                flush()
            for name in names[at:]:
                where[name].pop()
            del names[at:], blocks[at:], drops[at:]

        def last(tags: tuple[str, ...]) -> int:
            return max((where[t][-1] for t in tags if where[t]), default=0)

        at, end, last_tag = 0, len(html), html.rfind(">")
        while at < end:
            m = TAG.search(html, at) if at <= last_tag or html.find("<!--", at) >= 0 else None
            if m is None:
                say(html[at:])
                break
            if m.start() > at:
                say(html[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag, raw = name.lower(), m[3] or m[6] or ""
            if m[1] or m[4]:
                if tag == "br":
                    say(" ")
                place = where[tag][-1] if where[tag] else 0
                if place and (tag in END_FREE or place >= last(END_BOUNDS)):
                    close(place)
                continue
            if tag == "html":
                continue
            if tag == "br":
                say(" ")
                continue
            if tag in CLOSES_P and where["p"] and where["p"][-1] > last(P_BOUNDS):
                close(where["p"][-1])
            if tag in IMPLIED:
                closes, bounds = IMPLIED[tag]
                place = last(closes)
                if place > last(bounds):
                    close(place)
            label, drop = _attributes(tag, raw) if raw and not raw.isspace() else (tag, False)
            drop = drop or drops[-1] or tag in DROPPED or (tag == "header" and not where["article"] and not where["main"])
            block = blocks[-1]
            if tag in BLOCKS:
                flush()
                block = len(self.tags)
                self.tags.append(tag)
                self.labels.append(label)
                self.parents.append(blocks[-1])
                self.dropped.append(drop)
            if tag in VOID:
                continue
            if tag in RAW:
                found = _closing(tag).search(html, at)
                at = found.end() if found else end
                continue
            where[tag].append(len(names))
            names.append(tag)
            blocks.append(block)
            drops.append(drop)
        flush()

    def main_text(self, skip: frozenset | set = frozenset()) -> str:
        """The lines of all mains, else of all articles, else of the page, but menus; lines in skip left out."""
        kept = [i for i in range(len(self.lines)) if i not in skip]
        for tag in ("main", "article"):
            inside = [False] * len(self.tags)
            for b in range(1, len(self.tags)):
                inside[b] = inside[self.parents[b]] or (self.tags[b] == tag and not self.dropped[b])
            if any(inside):
                if own := [i for i in kept if inside[self.lines[i][0]]]:
                    return "\n".join(text for block, text, linked in (self.lines[i] for i in own) if linked < len(text) or self.tags[block] in PROSE)
                if not skip:
                    return ""
        return "\n".join(text for block, text, linked in (self.lines[i] for i in kept) if linked < 0.8 * len(text) or self.tags[block] in PROSE)


@lru_cache(32)
def _closing(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}[^>]*>", re.I)


class Tree:
    """The block elements that are not left out, like siblings as one: labels, parents and children by label."""

    __slots__ = ("labels", "parents", "kids")

    def __init__(self, labels: list[str] | None = None, parents: list[int] | None = None) -> None:
        self.labels, self.parents = labels or [], parents or []
        self.kids: list[dict[str, int]] = [{} for _ in self.labels]
        for i, p in enumerate(self.parents[1:], 1):
            self.kids[p][self.labels[i]] = i

    @classmethod
    def of(cls, page: Page) -> tuple[Tree, list[int]]:
        """The tree of a page, and the node of each of its blocks (-1: left out)."""
        tree, node = cls(), []
        for label, parent, dropped in zip(page.labels, page.parents, page.dropped):
            if dropped:
                node.append(-1)
                continue
            up = node[parent] if parent >= 0 else -1
            at = tree.kids[up].get(label, -1) if up >= 0 else -1
            if at < 0:
                at = len(tree.labels)
                tree.labels.append(label)
                tree.parents.append(up)
                tree.kids.append({})
                if up >= 0:
                    tree.kids[up][label] = at
            node.append(at)
        return tree, node


def _heaviest(places: list[int], weights: list[int]) -> tuple[int, list[int]]:
    """The heaviest subsequence of increasing places: its weight and its members."""
    if all(a < b for a, b in zip(places, places[1:])):
        return sum(weights), list(range(len(places)))
    at, best, who, before = [], [], [], [-1] * len(places)  # best weight of a chain that ends at or before each place
    for i, (p, w) in enumerate(zip(places, weights)):
        k = bisect_left(at, p)
        total = w + (best[k - 1] if k else 0)
        before[i] = who[k - 1] if k else -1
        stop = k
        while stop < len(at) and best[stop] <= total:
            stop += 1
        at[k:stop], best[k:stop], who[k:stop] = [p], [total], [i]
    chain, i = [], who[-1]
    while i >= 0:
        chain.append(i)
        i = before[i]
    return best[-1], chain[::-1]


def match(a: Tree, b: Tree) -> tuple[int, dict[int, int]]:
    """Simple tree matching: the most nodes of two trees that can be matched in order under matched parents, and the
    matched node of b for each node of a."""
    if not a.labels or not b.labels or a.labels[0] != b.labels[0]:
        return 0, {}
    pairs = [(0, 0)]  # a pair for each common path; parents before children
    inner: list[list[int]] = []
    for x, y in pairs:
        theirs = b.kids[y]
        found = [(k, theirs[label]) for label, k in a.kids[x].items() if label in theirs]
        inner.append(list(range(len(pairs), len(pairs) + len(found))))
        pairs.extend(found)
    weight, chosen = [1] * len(pairs), [[] for _ in pairs]
    for i in range(len(pairs) - 1, -1, -1):
        if inner[i]:
            # children were numbered as they first occur, so node numbers are places among siblings
            total, members = _heaviest([pairs[j][1] for j in inner[i]], [weight[j] for j in inner[i]])
            weight[i], chosen[i] = 1 + total, [inner[i][k] for k in members]
    out, todo = {}, [0]
    while todo:
        i = todo.pop()
        out[pairs[i][0]] = pairs[i][1]
        todo.extend(chosen[i])
    return weight[0], out


def _mark(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "replace")) >> 1


class Template:
    """A tree with numbered lines: node and mark of each."""

    def __init__(self, labels: list[str], parents: list[int], nodes: list[int], marks: list[int]) -> None:
        self.tree, self.nodes, self.marks = Tree(labels, parents), nodes, marks


def induce(pages: list[str], wrapper: str | None = None) -> str | None:
    """The templates of a host's pages as JSON, behind those of wrapper: the tree of each page unlike those before it, with its
    lines and those of the like pages at the nodes they match."""
    found: list[tuple[Tree, set[tuple[int, int]]]] = [(t.tree, set(zip(t.nodes, t.marks))) for t in templates(wrapper)] if wrapper else []
    for html in pages:
        page = Page(html)
        tree, node = Tree.of(page)
        lines = {(node[b], _mark(text)) for b, text, _ in page.lines if node[b] >= 0}
        like, back, k = max(((n, {y: x for x, y in met.items()}, k) for k, (n, met) in enumerate(_likeness(t, tree) for t, _ in found)), key=lambda x: x[0], default=(0.0, {}, -1))
        if like < SAME_TEMPLATE:
            found.append((tree, lines))
        else:
            found[k][1].update((back[n], m) for n, m in lines if n in back)
    return json.dumps([[t.labels, t.parents, *map(list, zip(*sorted(lines)))] if lines else [t.labels, t.parents, [], []] for t, lines in found]) if found else None


@lru_cache(256)
def templates(wrapper: str) -> list[Template]:
    return [Template(*t) for t in json.loads(wrapper)]


def _likeness(a: Tree, b: Tree) -> tuple[float, dict[int, int]]:
    n, met = match(a, b)
    return 2 * n / max(1, len(a.labels) + len(b.labels)), met


def align(page: Page, wrapper: str) -> tuple[int, dict[int, set[int]], dict[int, list[int]]]:
    """The template a page fits best (-1: none), and for each matched node of it the marks and numbers of the page's lines."""
    tree, node = Tree.of(page)
    best, which, met = 0.0, -1, {}
    for k, t in enumerate(templates(wrapper)):
        like, pairs = _likeness(t.tree, tree)
        if like >= SAME_TEMPLATE and like > best:
            best, which, met = like, k, pairs
    back = {y: x for x, y in met.items()}
    marks: dict[int, set[int]] = {x: set() for x in met}
    numbers: dict[int, list[int]] = defaultdict(list)
    for i, (b, text, _) in enumerate(page.lines):
        x = back.get(node[b], -1)
        if x >= 0:
            marks[x].add(_mark(text))
            numbers[x].append(i)
    return which, marks, numbers


def main_text(html: str | None, wrapper: str | None = None, constant: list[int] | None = None) -> tuple[str, bool]:
    """The text of a page and whether it fits a template; constant: numbers of the wrapper's lines that are template."""
    if not html:
        return "", False
    page = Page(html)
    which = -1
    if wrapper:
        which, marks, numbers = align(page, wrapper)
        if which >= 0 and constant:
            base = sum(len(t.marks) for t in templates(wrapper)[:which])
            t, skip = templates(wrapper)[which], set()
            fixed: dict[int, set[int]] = defaultdict(set)
            for c in constant:
                if base <= c < base + len(t.marks):
                    fixed[t.nodes[c - base]].add(t.marks[c - base])
            for x, same in fixed.items():
                if x in marks and not same.isdisjoint(marks[x]):
                    skip.update(i for i in numbers[x] if _mark(page.lines[i][1]) in same)
            if skip and (text := page.main_text(skip)):
                return text, True
    return page.main_text(), which >= 0


def count_lines(pages: list[tuple[str, str, str]], sums: dict) -> None:
    """Add pages (host, html, wrapper) to sums: for each template line, pages that have its node, and its line there."""
    for host, html, wrapper in pages:
        which, marks, _ = align(Page(html), wrapper)
        if which < 0:
            continue
        base = sum(len(t.marks) for t in templates(wrapper)[:which])
        t = templates(wrapper)[which]
        for i, (n, m) in enumerate(zip(t.nodes, t.marks)):
            if n in marks:
                held = sums.setdefault((host, base + i), [0, 0])
                held[0] += 1
                held[1] += m in marks[n]


def count_all(pages: list[tuple[str, str, str]], sums: dict) -> None:
    """Add pages (host, html, wrapper) to sums: for each node of each template the pages that have it (mark None), and for each
    line there the pages that have it."""
    for host, html, wrapper in pages:
        which, marks, _ = align(Page(html), wrapper)
        for x, own in marks.items() if which >= 0 else ():
            for m in (None, *own):
                key = (host, which, x, m)
                sums[key] = sums.get(key, 0) + 1


def constant_only(wrapper: str, constant: list) -> str:
    """The wrapper with no lines but its constant ones, (template, node, mark) each."""
    lines = [[(n, m) for k, n, m in constant if k == which] for which in range(len(templates(wrapper)))]
    return json.dumps([[t.tree.labels, t.tree.parents, [n for n, _ in own], [m for _, m in own]] for t, own in zip(templates(wrapper), lines)])


def _host(pages: DataFrame, url: str):
    return F.lower(F.regexp_extract(pages[url], HOST, 1))


def _beside(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Pages with the wrapper of their host: broadcast where the measured size allows, else joined by host."""
    width = F.sum(sum((F.length(F.to_json(F.struct(c))) for c in wrappers.columns), F.lit(0)))
    size = wrappers.agg(width).first()[0] or 0
    return pages.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host", "left")


def _induced(named: DataFrame, sample: int) -> DataFrame:
    """(host, wrapper): templates that every page (host, mark, html) of the host fits; written."""
    left, known = named, None
    while True:
        slot = F.pmod("mark", F.lit(sample)).alias("slot")
        chosen = written(left.groupBy("host", slot).agg(F.min("mark").alias("mark")), "sampled")
        size = chosen.agg(F.sum(F.length("host") + 32)).first()[0] or 0
        pick = F.broadcast(chosen.select("host", "mark")) if size <= BROADCAST_BYTES else chosen.select("host", "mark")
        some = left.join(pick, ["host", "mark"]).dropDuplicates(["host", "mark"]).select("host", "mark", "html")
        some = some.withColumn("wrapper", F.lit(None).cast("string")) if known is None else _beside(some, known)

        def learn(key, group):
            order = sorted(zip(group.column("mark").to_pylist(), group.column("html").to_pylist()))
            found = induce([h for _, h in order], group.column("wrapper")[0].as_py())
            return pa.table({"host": pa.array([key[0].as_py()] if found else [], pa.string()), "wrapper": pa.array([found] if found else [], pa.string())})

        more = written(some.groupBy("host").applyInArrow(learn, "host string, wrapper string"), "templates")
        known = more if known is None else written(known.join(more, "host", "left_anti").unionByName(more), "templates")

        def unlike(batches):
            for b in batches:
                for at in range(0, b.num_rows, 200):
                    part = b.slice(at, 200)
                    rows = zip(part.column("html").to_pylist(), part.column("wrapper").to_pylist())
                    yield part.select(["host", "mark", "html"]).filter(pa.array([align(Page(h), w)[0] < 0 for h, w in rows], pa.bool_()))

        # a page that a round took fits itself, so that every round leaves fewer; hosts without pages left stay as they are
        beside = _beside(left, more).filter("wrapper is not null").select("host", "mark", "html", "wrapper")
        rest = written(beside.mapInArrow(unlike, "host string, mark long, html string"), "unlike")
        if left is not named:
            forget(left)
        if rest.isEmpty():
            return known
        left, sample = rest, max(sample, min(2 * sample, MOST))


def wrappers(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper, constant): the templates of each host with their constant lines, and the numbers of these; written."""
    mark = F.xxhash64(pages[id_col].cast("string"), pages[url])
    named = pages.select(_host(pages, url).alias("host"), mark.alias("mark"), pages[html].alias("html")).filter("host != '' and html != ''")
    known = _induced(named, sample)

    def count(batches):
        sums: dict = {}

        def out():
            cells = list(zip(*sums)) if sums else [(), (), (), ()]
            columns = [pa.array(c, kind) for c, kind in zip((*cells, sums.values()), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["host", "template", "node", "mark", "n"])

        for b in batches:
            for at in range(0, b.num_rows, 200):
                columns = (b.column(c).slice(at, 200).to_pylist() for c in ("host", "html", "wrapper"))
                count_all([p for p in zip(*columns) if p[2]], sums)
                if len(sums) > FLUSH:
                    yield out()
                    sums.clear()
        yield out()

    counted = _beside(named.select("host", "html"), known).select("host", "html", "wrapper").mapInArrow(count, "host string, template int, node int, mark long, n long")
    total = counted.groupBy("host", "template", "node", "mark").agg(F.sum("n").alias("n"))
    often = written(total.filter(F.col("mark").isNull() | (F.col("n") >= CONSTANT * LEAST_PAGES)), "lines")
    held = often.filter("mark is null").select("host", "template", "node", F.col("n").alias("pages"))
    fixed = often.filter("mark is not null").join(held, ["host", "template", "node"]).filter((F.col("pages") >= LEAST_PAGES) & (F.col("n") >= CONSTANT * F.col("pages")))
    constant = fixed.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("template", "node", "mark"))).alias("lines"))  # no more than a page of each template has, a ninth more

    def put(batches):
        for b in batches:
            lines = [[(x["template"], x["node"], x["mark"]) for x in own or ()] for own in b.column("lines").to_pylist()]
            found = [constant_only(w, own) for w, own in zip(b.column("wrapper").to_pylist(), lines)]
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(found, pa.string()), pa.array([list(range(len(own))) for own in lines], pa.list_(pa.int64()))], ["host", "wrapper", "constant"])

    return written(known.join(constant, "host", "left").select("host", "wrapper", "lines").mapInArrow(put, "host string, wrapper string, constant array<long>"), "wrappers")


def extract(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, aligned) for each row of pages; aligned: the page fits a template of its host."""
    known = wrappers(pages, sample, id_col, url, html)
    named = pages.select(pages[id_col].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"), _host(pages, url).alias("host"))
    source = _beside(named, known).select("page_id", "url", "html", "wrapper", "constant")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                some = b.slice(at, 200)
                found = [main_text(*row) for row in zip(*(some.column(c).to_pylist() for c in ("html", "wrapper", "constant")))]
                texts = [t for t, _ in found]
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([a for _, a in found], pa.bool_())], ["page_id", "url", "text", "n_chars", "aligned"])

    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, aligned boolean")
