import random
import tracemalloc
import zlib

import pytest

from townlens.llm import toxicity

BAD = ["idiot", "moron", "scumbag", "worthless", "clown"]
rng = random.Random(5)
PARTS = ["er", "an", "the", "tion", "in", "on", "at", "ing", "ou", "es", "li", "do", "mo", "st"]


def word():
    return "".join(rng.choices(PARTS, k=rng.randint(1, 3)))


def prose(n=60, bad=0):
    words = [word() for _ in range(n)]
    for _ in range(bad):
        words.insert(rng.randrange(n), rng.choice(BAD))
    return " ".join(words).capitalize() + "."


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = [], []
    for i in range(900):
        toxic = i % 9 == 0
        docs.append((i, prose(bad=3 if toxic else 0), "en", 9.0))
        labels.append((i, 1 - toxic, int(toxic if rng.random() > 0.02 else not toxic), "x"))
    copied = prose() + " zyxxy unique marker"
    docs += [(1000 + i, copied, "en", 0.0) for i in range(40)]
    labels += [(1000 + i, 1, 1, "x") for i in range(40)]
    hidden = ["an 1d1ot on", "you are a m0r0n", "what a s c u m b a g here", "w o r t h l e s s", "worthle$$ er", "cl*wn", "IDIIIIIOT!!!", "i.d.i.o.t", "(lown ing"]
    docs += [(2000 + i, f"{prose(20)} {t} {prose(20)}", "en", 0.0) for i, t in enumerate(hidden)]
    clean = ["of%%% the&&& an*** er$$$", "THE!! AN!! ER!!", "é è ê à x y z", "1 2 3 4 5", "", None, "tion " * 60_000, "a@b.com +1 (017) 555-7713 token = \"04dbebab91ab85687d33\"", "iiiiiiiii"]
    docs += [(3000 + i, t, None, None) for i, t in enumerate(clean)] + [(None, "no id", None, None), (3001, clean[1], None, None)]
    labels += [(5, None, None, None), (None, 1, 1, "x"), (99_999, 0, 1, "x"), (7, 1, 0, "again")]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, score double").repartition(6), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_scores(tables):
    rows = [r for r in toxicity.score(*tables).collect()]
    assert len(rows) == 960
    got = {r["doc_id"]: r for r in rows}
    for i, r in got.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
    assert all(got[i]["predicted"] == (i % 9 == 0) for i in range(900))
    assert all(got[i]["predicted"] == 0 for i in range(1000, 1040)), "copies of one labelled text are no evidence"
    assert all(got[2000 + i]["predicted"] for i in range(9)), [i for i in range(9) if not got[2000 + i]["predicted"]]
    assert not any(got[3000 + i]["predicted"] for i in range(9))


def test_rejection_keeps_clean_rows_whole(tables):
    docs, labels = tables
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.schema == docs.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == 960 - 100 - 9 and ids.count(3001) == 2 and None in ids


def test_restore(tables):
    bits = toxicity.char_model(toxicity.char_counts(tables[0]))
    assert toxicity.restore("the m0r0n an", bits) == "the moron an"
    assert toxicity.restore("an i d i o t on", bits) == "an idiot on"


def test_counts_equal_plain_counting():
    texts = ["Ab, ab!", "é日", "", "x"]
    symbols = [0, 0, 0]
    for t in ["", *texts, ""]:
        for c in (t + "\n").lower():
            s = 1 + ord(toxicity.ACCENTS.get(c, c)) - 97 if "a" <= toxicity.ACCENTS.get(c, c) <= "z" else 27 if c.isalpha() else 0
            if s or symbols[-1]:
                symbols.append(s)
    counts = toxicity.gram_counts(texts)
    want = {}
    for a in zip(*(symbols[i:] for i in range(4))):
        code = ((a[0] * 28 + a[1]) * 28 + a[2]) * 28 + a[3]
        want[code] = want.get(code, 0) + 1
    assert {i: n for i, n in enumerate(counts) if n} == want


def test_no_labels_and_empty_tables(spark, tables):
    docs, labels = tables
    assert {r["predicted"] for r in toxicity.score(docs.limit(20), labels.limit(0)).collect()} == {0}
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert toxicity.reject_toxic(docs.limit(0), labels.limit(0)).count() == 0


def test_spaced_words_at_edges_and_second_words():
    local = random.Random(7)
    filler = ["".join(local.choices(PARTS, k=local.randint(1, 3))) for _ in range(3000)]
    bits = toxicity.char_model(toxicity.gram_counts([" ".join(filler + ["idiot", "moron"] * 40)]))
    reader = toxicity.Speller(["idiot", "moron"], bits)
    for t in ("i d i o t.", "i d i o t,", "i d i o t!", '"i d i o t"', "(i d i o t)", "i  d  i  o  t", "i\nd\ni\no\nt", "i \t d i   o t?", "y o u  i d i o t"):
        assert reader.text_hits(f"an {t} on") == {0}, t
    for t in ("idiot/m0r0n", "m0r0n,idiot!", "idiot+m0r0n", "m0r0n/1d1ot"):
        assert reader.text_hits(t) == {0, 1}, t
    assert reader.text_hits("a b c d. e  f  g") == set()


def test_scores_are_those_of_the_restored_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] or "" for r in docs.collect()]
    counts = toxicity.char_counts(docs)
    model = toxicity.learn(toxicity.training_sample(*(spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))))
    lexicon = model["lexicon"] + ["asshole", "moron", "crétin"]
    bits = toxicity.char_model(counts + 50 * toxicity.gram_counts([" ".join(lexicon)]))
    reader = toxicity.Speller(lexicon, bits)
    local = random.Random(2)
    for w in lexicon:
        for _ in range(12):
            spelt = "".join(local.choice([c, c, c.upper(), c * local.choice([2, 4]), c + local.choice("._-*%1!"), *(x for x, y in toxicity.LEET.items() if c in y)]) for c in w)
            texts.append(f"{local.choice(['', '(', '!!', 'of-'])}{spelt}{local.choice(['', ',', '%%%', '###', '***', '/the', '!'])} {' '.join(w)}. {'  '.join(w)}")
    texts += ["m" + "." * 170 + "0r0n", "fuckk assholee", "idiot-m0r0n", "x" * 3000 + "m0r0n", "m o r o n " * 300, "(#<" * 900, "|-" * 500, "* a * b *", "\t\n", "ıI İ ﬁ", "l'idiot, idiot's"]
    found = 0
    for t in texts:
        restored = set(toxicity.LETTERS.findall(toxicity.restore(t, bits, reader.words)))
        want = {i for w, i in reader.words.items() if w in restored}
        assert reader.text_hits(t) == want, t[:300]
        found += len(want)
    assert found > 200
    one = lambda t: {lexicon[i] for i in reader.text_hits(t)}
    assert one("m" + "." * 170 + "0r0n") == {"moron"} and one("idiot-m0r0n") >= {"moron"} and one("assholee") == {"asshole"}


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    # some labels are wrong on purpose: documents without any telling word that are marked, and the other way round
    assert sum(caught) >= 0.85 * len(caught) > 50 and sum(clean) <= 0.03 * len(clean)


def test_gram_counts_in_bounded_memory(monkeypatch):
    texts = ["a1b  c!! é" * 4000] * 500
    tracemalloc.start()
    whole = toxicity.gram_counts(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 and whole.sum() > 0
    few = ["", "a", "", "é!!  b", "  x"]
    want = toxicity.gram_counts(few)
    for n in (1, 2, 3, 7):
        monkeypatch.setattr(toxicity, "CHUNK", n)
        assert (toxicity.gram_counts(few) == want).all()
