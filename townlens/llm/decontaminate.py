"""Benchmark decontamination over template-canonical windows, in DataFrame operations only.

Words are made comparable by case and edge punctuation, and the parts of a question that a rewrite changes become typed
placeholders: numbers, units behind a number, and names (capitalised words inside a sentence; a name of several words is
one). A placeholder is written into the text with its value behind it, so that one split gives the canonical words and
the values in step. Windows of WINDOW canonical words (shorter items: one window of all their words) are hashed; a window
of placeholders alone says nothing and is left out, and an item that has no other windows is compared as it is written.

A document is contaminated by an item when at least LEAST_SHARE of the item's distinct windows meet on one alignment and
the placeholders of these windows are filled consistently: one value of the item always became one value of the document
(two may have become the same), or the windows meet whole, all of the item's, and then a repeated value may have become
several. `filling` says which: `kept` (one to one), `merged` (two values became one) or `parted`. An alignment is a place of the document with every window that meets within the
item's length of it, each at the nearest such place: words put in or left out shift the rest without ending it. Every
alignment with enough windows is judged.

Candidates come from a hash join of the documents' windows with the rarest windows of each item, so many that a document
which meets a share of LEAST_SHARE must meet one of them; a window that many items share is so rarely among them. Only
pairs (text, item) leave that join; places are looked up for these alone. The item side is broadcast while its measured
size is under BROADCAST_BYTES, beyond, the join shuffles.

Defined cases: null texts are empty; items without a word meet nothing; rows that share an item_id are judged each by its
own text and reported once, by the best of them; so are documents that share a doc_id; equal texts are judged once;
an empty benchmark reports nothing; rows without an id share the id null in `contaminated`, and `decontaminate` judges every
row by its text, whatever its id; very long texts are read whole, a row for each word while windows are made; columns of
other names, whatever they are, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import narrow, text_of, written

WINDOW, LEAST_SHARE = 8, 0.5
BROADCAST_BYTES = 16 << 20
#: Units that count as such behind a number.
UNITS = "kg|g|mg|km|m|cm|mm|miles?|feet|ft|inch(?:es)?|l|ml|litres?|liters?|seconds?|s|minutes?|min|hours?|h|days?|weeks?|months?|years?|percent|dollars?|euros?|cents?|degrees?"
#: Signs of private use: a placeholder begins (its type follows), its value ends, words of one name are joined.
BEGIN, END, JOIN = "\ue000", "\ue001", "\ue002"
OWN = f"[{BEGIN}-{JOIN}]"
#: A sign that is no part of a word; points and the like stay between digits.
EDGE = rf"[^\p{{L}}\p{{N}}{BEGIN}-{JOIN}\s\p{{Z}}](?:(?<![.,:/])|(?![0-9])|(?<![0-9].))"
#: A capitalised word inside a sentence counts as a name. The capital is looked for first, what goes before it then.
NAME = r"\p{Lu}\p{Ll}+"
INSIDE = r"\p{Lu}(?<=[\p{Ll}\p{N}][,;:]?[ \t]\p{Lu})\p{Ll}+"
NO_MORE = r"(?![\p{L}\p{N}])"
#: Repeated groups are possessive, here and below: Java matches others by recursion, and a list of some thousand numbers or
#: names then overflows the stack, which ends the executor. Nothing is given back: a part that repeats ends where it must.
NUMBER = rf"([0-9]+(?:[.,:/][0-9]+)*+)(?:([ \t])((?i:{UNITS})){NO_MORE})?"
SPACE = r"[\s\p{Z}]+"


def marked_text(text: Column) -> Column:
    """Lower-case words with white space between them, placeholders and their values written in. Each step names the one
    before once, so that a text goes through each pattern once."""
    t = F.regexp_replace(text, OWN, "")
    t = F.regexp_replace(t, rf"({INSIDE})[ \t](?={NAME}{NO_MORE})", f"$1{JOIN}")
    t = F.regexp_replace(t, rf"{INSIDE}(?:{JOIN}{NAME})*+{NO_MORE}", f"{BEGIN}p$0{END}")
    t = F.regexp_replace(t, NUMBER, f"{BEGIN}n$1{END}$2{BEGIN}u$3{END}")
    t = F.replace(t, F.lit(f"{BEGIN}u{END}"), F.lit(""))
    return F.regexp_replace(F.lower(t), EDGE, "")


def canonical(marked: Column) -> Column:
    """The same words without the values."""
    return F.regexp_replace(marked, rf"{BEGIN}([nup])[^{END}\s]*+{END}", f"{BEGIN}$1")


def words(joined: Column) -> Column:
    return F.array_remove(F.split(joined, SPACE), "")


def _codes(w: Column, as_written: bool) -> Column:
    """A number for each word; odd where it holds a placeholder that is compared as such."""
    code = lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2))
    return F.transform(w, code if as_written else lambda x: code(x) + x.contains(BEGIN).cast("long"))


def windows(df: DataFrame, keys: list[str], sizes: list[int], at: str) -> DataFrame:
    """(keys, at, hash): the hash of each window of the array column w (of codes), and its place; one pass for all sizes.
    Places are exploded, not windows: generated code then reads the codes from the one array of the row."""
    rows = df.filter(F.size("w") >= min(sizes)).select(*keys, "w", F.explode(F.sequence(F.lit(0), F.size("w") - min(sizes))).alias(at))

    def hashed(n: int) -> Column:
        cells = [F.get("w", F.col(at) + k) for k in range(n)]
        told = cells[0]
        for c in cells[1:]:
            told = told.bitwiseAND(c)
        # a window that ends beyond the last word has null codes
        return F.when(told.bitwiseAND(F.lit(1)) == 0, F.xxhash64(F.lit(n), *cells))

    if len(sizes) == 1:
        return rows.select(*keys, at, hashed(sizes[0]).alias("hash")).filter("hash is not null")
    return rows.select(*keys, at, F.explode(F.array(*[hashed(n) for n in sizes])).alias("hash")).filter("hash is not null")


def read_items(benchmark: DataFrame, window: int, item_col: str, text: str) -> DataFrame:
    """(item, item_id, size, marked, plain): a key for each distinct row, its window size, and its texts."""
    items = narrow(benchmark, item_col, text).select(F.col("doc_id").alias("item_id"), "text")
    items = items.withColumn("item", F.xxhash64(F.col("item_id").cast("string"), "text")).dropDuplicates(["item"])
    items = items.withColumn("marked", marked_text(F.col("text"))).withColumn("plain", canonical(F.col("marked")))
    return items.withColumn("size", F.least(F.size(words(F.col("plain"))), F.lit(window))).filter("size > 0").drop("text")


def item_windows(items: DataFrame, as_written: bool) -> DataFrame:
    """(item, hash, q, windows, reach): the distinct windows of each item, the first place of each."""
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most `window` numbers
    text = F.col("marked" if as_written else "plain")
    source = items.select("item", "size", _codes(words(text), as_written).alias("w"))
    out = None
    for n in sizes:
        some = windows(source.filter(F.col("size") == n), ["item"], [n], "q")
        out = some if out is None else out.unionByName(some)
    first = out.groupBy("item", "hash").agg(F.min("q").alias("q"))
    return first.join(first.groupBy("item").agg(F.count("*").alias("windows")), "item").join(source.select("item", F.size("w").alias("reach")), "item")


def _small(df: DataFrame, width: int) -> DataFrame:
    """A hint to broadcast df if its rows, of width bytes, are few enough."""
    return F.broadcast(df) if df.count() * width <= BROADCAST_BYTES else df


def _meet(texts: DataFrame, items: DataFrame, known: DataFrame, least_share: float, as_written: bool) -> DataFrame:
    """(row, item, matched, windows, slots, consistent, filling) of each text (row, text) and item, the best of their alignments."""
    sizes = sorted(r["size"] for r in items.join(known.select("item").distinct(), "item", "left_semi").select("size").distinct().collect())
    marked = marked_text(F.col("text"))
    coded = texts.select("row", (marked if as_written else canonical(marked)).alias("joined")).select("row", _codes(words(F.col("joined")), as_written).alias("w"))

    # any share of LEAST_SHARE of n windows holds one of the n - need + 1 rarest
    need = F.ceil(F.col("windows") * least_share)
    common = known.groupBy("hash").agg(F.count("*").alias("items"))
    order = F.sort_array(F.collect_list(F.struct("items", "hash")))
    rarest = known.join(common, "hash").groupBy("item").agg(order.alias("h"), F.first("windows").alias("windows")).select("item", F.explode(F.slice("h", F.lit(1), (F.col("windows") - need + 1).cast("int"))).alias("h"))
    probes = written(rarest.select("item", F.col("h.hash").alias("hash")), "probes")
    pairs = written(windows(coded, ["row"], sizes, "p").join(_small(probes, 40), "hash").select("row", "item").distinct(), "pairs")

    mine = texts.join(pairs.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"]).select("row", marked.alias("marked"))
    mine = written(mine.withColumn("plain", F.col("marked") if as_written else canonical(F.col("marked"))), "asked")
    placed = windows(mine.select("row", _codes(words(F.col("plain")), as_written).alias("w")), ["row"], sizes, "p")
    wanted = pairs.join(known, "item")
    hits = wanted.join(placed, ["row", "hash"]).select("row", "item", "q", "p", "windows", "reach", (F.col("p") - F.col("q")).alias("shift"))
    enough = lambda n: n >= F.ceil(F.col("windows") * least_share)
    full = hits.groupBy("row", "item").agg(F.count_distinct("q").alias("n"), F.first("windows").alias("windows")).filter(enough(F.col("n"))).select("row", "item")
    hits = written(hits.join(full, ["row", "item"], "left_semi"), "hits")

    at = F.floor(F.col("shift") / F.col("reach"))
    anchors = hits.select("row", "item", F.col("shift").alias("at"), at.alias("k")).distinct().select("row", "item", "at", F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1)).alias("bucket"))
    off = F.abs(F.col("shift") - F.col("at"))
    near = hits.withColumn("bucket", at).join(anchors, ["row", "item", "bucket"]).filter(off <= F.col("reach"))
    ways = near.groupBy("row", "item", "at", "q").agg(F.min_by("p", F.struct(off, "p")).alias("p"), F.first("windows").alias("windows"))
    sizes_of = ways.groupBy("row", "item", "at").agg(F.count("*").alias("matched"), F.first("windows").alias("windows")).filter(enough(F.col("matched"))).select("row", "item", "at", "matched")
    ways = written(ways.join(sizes_of, ["row", "item", "at"]), "ways")

    slot = lambda df, key, place: df.select(key, F.posexplode(F.arrays_zip(words(F.col("plain")).alias("c"), words(F.col("marked")).alias("v"))).alias(place, "x")).select(key, place, "x.c", "x.v")
    theirs = slot(items.join(known.select("item").distinct(), "item", "left_semi"), "item", "i").filter(F.col("c").contains(BEGIN))
    values = slot(mine, "row", "d").filter(F.col("c").contains(BEGIN)).select("row", "d", F.col("v").alias("dv"))
    inner = ways.join(items.select("item", "size"), "item").select("row", "item", "at", F.explode(F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda j: F.struct((F.col("q") + j).alias("i"), (F.col("p") + j).alias("d")))).alias("x")).select("row", "item", "at", "x.i", "x.d").distinct()
    filled = inner.join(theirs, ["item", "i"]).join(values, ["row", "d"]).select("row", "item", "at", "c", "v", "dv").distinct()
    judged = filled.groupBy("row", "item", "at").agg((F.count("*") == F.count_distinct("c", "v")).alias("to"), (F.count("*") == F.count_distinct("c", "dv")).alias("fro"))
    verdict = ways.select("row", "item", "at", "matched", "windows").distinct().join(judged, ["row", "item", "at"], "left")
    to, fro = F.coalesce("to", F.lit(True)), F.coalesce("fro", F.lit(True))
    consistent = to | (F.col("matched") == F.col("windows"))
    filling = F.when(to & fro, "kept").when(to, "merged").otherwise("parted")
    best = verdict.groupBy("row", "item").agg(F.max(F.struct(consistent.alias("consistent"), "matched", (to & fro).alias("kept"), filling.alias("filling"))).alias("best"), F.first("windows").alias("windows"))
    slots = theirs.groupBy("item").agg(F.count("*").cast("int").alias("slots"))
    return best.join(slots, "item", "left").select("row", "item", "best.matched", F.col("windows").cast("int").alias("windows"), F.coalesce("slots", F.lit(0)).alias("slots"), "best.consistent", "best.filling")


def _found(source: DataFrame, items: DataFrame, least_share: float) -> DataFrame | None:
    """What _meet() finds of the texts of source (row, text), with the item_id; None without items."""
    found = None
    if not items.isEmpty():
        known = written(item_windows(items, False), "windows")
        # items of placeholders alone
        bare = written(items.join(known.select("item").distinct(), "item", "left_anti"), "bare")
        found = _meet(source, items, known, least_share, False)
        if not bare.isEmpty():
            found = found.unionByName(_meet(source, bare, written(item_windows(bare, True), "windows"), least_share, True))
    return None if found is None else written(found.join(items.select("item", "item_id"), "item"), "found")


def _row(text: Column) -> Column:
    return F.xxhash64(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, matched, windows, share, slots, consistent, filling) of each document and item that meet."""
    items = written(read_items(benchmark, window, item_col, text), "items")
    source = narrow(docs, id_col, text).withColumn("row", _row(F.col("text")))
    kinds = source.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    found = _found(source, items, least_share)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {kinds[0]}, item_id {kinds[1]}, matched long, windows int, share double, slots int, consistent boolean, filling string")
    named = source.select("doc_id", "row").join(_small(found, 128), "row")
    share = (F.col("matched") / F.col("windows").cast("double")).alias("share")
    best = named.groupBy("doc_id", "item_id").agg(F.max(F.struct("consistent", share, "matched", "windows", "slots", "filling")).alias("best"))
    return best.select("doc_id", "item_id", *[f"best.{c}" for c in ("matched", "windows", "share", "slots", "consistent", "filling")])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of docs whose texts no item contaminates, each judged by its own text."""
    items = written(read_items(benchmark, window, item_col, text), "items")
    found = _found(narrow(docs, id_col, text).withColumn("row", _row(F.col("text"))), items, least_share)
    if found is None:
        return docs
    bad = written(found.filter("consistent").select(F.col("row").alias("_bad")).distinct(), "contaminated")
    return docs.join(bad, _row(text_of(docs, text)) == bad["_bad"], "left_anti")
