import random
import re
from collections import defaultdict

import pytest

from townlens.llm import decontaminate as d

rng = random.Random(11)
VOCABULARY = [f"w{c}{e}" for c in "abcdefghij" for e in ("er", "an", "ou", "ti")]


def prose(n):
    return " ".join(rng.choices(VOCABULARY, k=n))


ITEMS = [(i, prose(rng.randint(9, 40)).capitalize() + ".") for i in range(40)]
ITEMS += [(100, "A train leaves with 12 cars and each of the 12 cars holds 30 people, how many people ride with Anna in all"), (101, "short item here"), (102, ""), (103, None), (104, ITEMS[0][1])]
REWRITTEN = "A train leaves with 7 cars and each of the 7 cars holds 55 people, how many people ride with Peter in all"
BROKEN = "A train leaves with 7 cars and each of the 9 cars holds 55 people, how many people ride with Peter in all"


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(i, prose(rng.randint(1, 300))) for i in range(150)]
    docs += [(1000 + i, f"{prose(50)} {t} {prose(50)}") for i, t in enumerate(x[1] for x in ITEMS[:40])]
    docs += [(2000, f"{prose(20)}. {REWRITTEN} {prose(9)}"), (2001, BROKEN), (2002, f"x {' '.join(ITEMS[3][1].split()[:4])}"), (2003, None), (2004, ""), (2005, ITEMS[5][1].upper() + "!!"), (2006, f"{prose(3)} SHORT, item here. {prose(3)}"), (2007, (ITEMS[6][1] + " ") * 300), (2008, prose(40_000)), (2000, REWRITTEN), (None, ITEMS[7][1])]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, p int").repartition(6), spark.createDataFrame([(i, t, 2) for i, t in ITEMS], "item_id long, text string, doc_id int")


def brute(docs, items):
    canon = lambda t: [w for w in (re.sub(r"[^\w]|_", "", w) for w in (t or "").lower().split()) if w]
    index = defaultdict(set)
    size = {}
    for i, t in items:
        w = canon(t)
        n = min(8, len(w))
        if n and not re.search(r"\d", t) or i < 100:
            size[i] = len(w) - n + 1
            for q in range(size[i]):
                index[tuple(w[q : q + n])].add((i, q))
    out = set()
    for k, t in docs:
        w, met = canon(t), defaultdict(set)
        for n in {min(8, 8), 3}:
            for p in range(len(w) - n + 1):
                for i, q in index.get(tuple(w[p : p + n]), ()):
                    met[i, p - q].add(q)
        out |= {(k, i) for (i, _), v in met.items() if 2 * len(v) >= size[i]}
    return out


def test_against_brute_force(tables):
    docs, benchmark = tables
    rows = d.contaminated(docs, benchmark).filter("consistent").collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows if r["item_id"] != 100}
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [x for x in ITEMS if x[0] != 100])
    assert got == want and len(want) > 40 and len(rows) == len({(r["doc_id"], r["item_id"]) for r in rows})


def test_slots(tables):
    found = {r["doc_id"]: r for r in d.contaminated(*tables).filter("item_id = 100").collect()}
    assert set(found) == {2000, 2001} and found[2000]["consistent"] and found[2001]["consistent"]
    assert found[2000]["filling"] == "kept" and found[2001]["filling"] == "parted"


def test_values_may_merge_and_part_only_where_windows_meet_whole(spark):
    item = "a tank holds 12 litres and the pump moves 30 litres in one hour so how long does it take to fill 40 pots and 40 jars with it"
    parted_half = " ".join(item.replace("40 jars", "70 jars").replace("40 pots", "55 pots").split()[6:]) + " or something else"
    texts = [item.replace("12", "15").replace("30", "15"), item.replace("40 jars", "70 jars").replace("40 pots", "55 pots"), parted_half, "we filled 40 pots and 70 jars with a pump that moves 9 litres in an hour"]
    rows = d.contaminated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["consistent"], r["filling"]) for r in rows} == {0: (True, "merged"), 1: (True, "parted"), 2: (False, "parted")}


def test_only_contaminated_documents_go(tables):
    docs, benchmark = tables
    kept = d.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids >= {*range(150), 2002, 2003, 2004, 2008} and not ids & {*range(1000, 1040), 2000, 2001, 2005, 2006, 2007, None}


def test_broadcast_and_shuffle_agree(tables, monkeypatch):
    one = sorted(map(tuple, d.contaminated(*tables).collect()), key=str)
    monkeypatch.setattr(d, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, d.contaminated(*tables).collect()), key=str) == one


def test_empty(spark, tables):
    docs, benchmark = tables
    assert d.contaminated(docs, benchmark.limit(0)).count() == 0 and d.contaminated(docs.limit(0), benchmark).count() == 0
    assert d.decontaminate(docs, benchmark.limit(0)).count() == docs.count()


def test_headings_and_hard_spaces_keep_slots_in_place(spark, tables):
    texts = [f"# Title\n\n## Part\n{ITEMS[40][1]}", f"two\u00a0words and\u2003more # {ITEMS[40][1]}", f"# {REWRITTEN}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = d.contaminated(docs, tables[1]).filter("item_id = 100 and consistent").collect()
    assert {r["doc_id"]: r["share"] for r in rows} == {0: 1.0, 1: 1.0, 2: 1.0}


def test_insertions_partial_copies_and_second_copies(spark):
    plain = " ".join(f"v{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(59))
    slots = ITEMS[40][1]
    twice = "a box holds pears for Anna while the other box over there holds plums for Peter and a third one holds figs for Anna in all of these days"
    items = spark.createDataFrame([(1, plain), (2, slots), (3, twice)], "item_id long, text string")
    w = plain.split()
    texts = [
        " ".join([*w[:30], "inserted", *w[30:]]),
        " ".join([*w[:29], *w[30:]]),
        " ".join(slots.split()[:20]) + " sing with anna and then the rest is about something else of 99 and 99",
        f"{BROKEN} and also {prose(30)} {REWRITTEN}",
        twice.replace("Anna", "Mary Ann").replace("Peter", "John Paul Lee"),
        twice.replace("Anna", "Mary Ann", 1),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["matched"], r["windows"]) for r in d.contaminated(docs, items).filter("consistent").collect()}
    assert got[0, 1] == (45, 52) and got[1, 1] == (44, 52)
    assert set(got) == {(0, 1), (1, 1), (2, 2), (3, 2), (4, 3), (5, 3)} and got[4, 3][0] == got[4, 3][1]


def test_repeated_ids_and_numbers_alone(spark):
    one, two, numbers = prose(30), prose(30), "3 1 4 1 5 9 2 6 5 3 5 8"
    items = spark.createDataFrame([(1, one), (1, two), (1, two), (2, numbers), (None, prose(20))], "item_id long, text string")
    rows = [(10, f"x {one}"), (10, f"y {two}"), (11, two), (11, "nothing here"), (12, f"the digits {numbers} end"), (13, "7 8 9 7 6 5 4 3 2 1 0 11 12 13 14 15"), (14, "0 " * 20_000), (None, two), (None, two)]
    df = spark.createDataFrame([(i, t, 1, "h") for i, t in rows], "doc_id long, text string, row int, hash string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in d.contaminated(df, items).filter("consistent").collect()), key=str)
    assert got == [(10, 1), (11, 1), (12, 2), (None, 1)]
    assert sorted(r["doc_id"] for r in d.decontaminate(df, items).collect()) == [11, 13, 14]


def test_canonical_words_and_values_in_step(spark):
    pieces = ["#", "##", "5", "3.5", "1/2", "12:30", "kg", "m", "Anna", "Mary", "Ann", "Lee-Ann", "AnnB", "word", "and,", "—", "½", " ", " ", "\n", "x2", "5kg", "\ue000n", "\ue001", "é", "_", ".5", "a.b", "it's", "  "]
    r = random.Random(5)
    rows = [(" ".join(r.choices(pieces, k=30)),) for _ in range(300)]
    got = spark.createDataFrame(rows, "text string").select("text", d.marked_text(d.F.col("text")).alias("m")).select("text", d.words(d.F.col("m")).alias("v"), d.words(d.canonical(d.F.col("m"))).alias("c")).collect()
    for x in got:
        assert len(x["v"]) == len(x["c"]) and "" not in x["v"] and "" not in x["c"], x
        for v, c in zip(x["v"], x["c"]):
            assert re.sub("\ue000([nup])[^\ue001]*\ue001", "\ue000\\1", v) == c


def test_windows_many_items_share(spark):
    """A beginning that all items share brings no pairs of its own; what an item adds to it decides."""
    start = prose(12)
    items = [(i, f"{start} {prose(14)}") for i in range(60)]
    rows = [(i, f"{prose(5)} {t} {prose(5)}") for i, t in items[:20]] + [(100 + i, f"{start} {prose(60)}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(rows, items) and got >= {(i, i) for i in range(20)}


def test_long_lists_of_numbers_and_names(spark):
    """Repeated groups are matched without recursion: a stack that overflows ends the executor."""
    texts = [(1, ",".join(str(i % 10) for i in range(60_000))), (2, "so said " + " ".join(["Anna Maria"] * 30_000) + " and others")]
    item = [(9, "the old mill stands by the river and turns no more these days")]
    docs = spark.createDataFrame([*texts, (3, item[0][1])], "doc_id long, text string")
    kept = d.decontaminate(docs, spark.createDataFrame(item, "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
