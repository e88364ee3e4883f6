import random

from pyspark.sql import functions as F

from townlens.llm import html_extract as h


def page(host, i, body, extra=""):
    return (i, f"https://{host}/p/{i}", f'<!DOCTYPE html><html><head><title>t{i}</title><style>p{{x:1}}</style></head><body><nav><ul><li><a href="/a">A{i}</a></li></ul></nav>{extra}{body}<footer>&copy; {host} {i}</footer></body></html>')


def plain(html):
    return h.main_text(html)[0]


def test_article_and_broken_markup():
    html = "<html><body><nav><a>Menu</a></nav><div class=\"ad\">Buy</div><article><h1>Title &amp and</h1><p><b>First\n  line &amp;&amp;.<br><p>Second &lt;b&gt;</p><script>var t='</p>'</script><p>a<i>b</i>c<form><input value=x>no</form><div class='comments'>nice</div></article><footer>x</footer>"
    assert plain(html) == "Title & and\nFirst line &&.\nSecond <b>\nabc"


def test_words_of_class_and_id():
    kept = '<article><p>a</p><section class="related-work"><p>b</p></section><div id="search-methods">c</div>'
    assert plain(f'{kept}<div class="related-posts">x</div><div class="x1 site-header">y</div><p data-id="ad">d</p></article>') == "a\nb\nc\nd"


def test_deep_and_unclosed_pages():
    for n in (300, 50_000):
        assert plain("<div>" * n + "<p>deep</p>" + "</div>" * n) == "deep"
        wrapper = h.induce(["<div>" * n + f"<p>text {k}</p>" for k in range(2)])
        assert h.main_text("<div>" * n + "<p>other</p>", wrapper) == ("other", True)
    assert plain("<td>" + "<span><i>" * 30_000 + "x" + "</span>" * 30_000) == "x"
    assert plain("<a " * 30_000 + "no end") and plain("<!-- open" * 3) == "" and plain("a<!-- b --") == "a"


def wrapped(pages):
    """What a host's pages give, with their own wrapper, as extract() computes it."""
    wrapper, sums = h.induce(pages), {}
    h.count_lines([("h", p, wrapper) for p in pages], sums)
    constant = sorted(k for (_, k), (n, same) in sums.items() if n >= h.LEAST_PAGES and same >= h.CONSTANT * n)
    return [h.main_text(p, wrapper, constant)[0] for p in pages]


def test_constant_nodes_are_template_and_slots_are_content():
    pages = [f'<html><body><div id="top"><a>Home</a><a>About</a></div><div class="wrap"><div class="lead">Lead {i}</div><div class="body"><h2>Head {i}</h2><p>Text number {i} {"word " * (20 + i)}</p><p>Write to us with your thoughts.</p><div>inner {i}</div></div><div class="box">Same for all pages, always the same long text here for sure</div></div></body></html>' for i in range(5)]
    got = wrapped(pages)
    assert got[2] == f"Lead 2\nHead 2\nText number 2 {('word ' * 22).strip()}\ninner 2"
    assert got[2] != plain(pages[2]) and "Same for all" in plain(pages[2]) and "Write to us" in plain(pages[2])
    article = [f"<article><p>Story {i} of the day</p><p>All rights reserved.</p></article>" for i in range(4)]
    assert wrapped(article)[1] == "Story 1 of the day"


def test_copies_and_small_hosts_keep_their_text():
    one = "<article><h1>T</h1><p>body</p></article>"
    assert wrapped([one] * 8) == ["T\nbody"] * 8 and wrapped([one, one]) == ["T\nbody"] * 2


def test_two_templates_of_one_host():
    a = [f'<div class="news"><h1>A{i}</h1><p>text {i}</p><p class="sig">Our desk wrote this</p></div>' for i in range(4)]
    b = [f'<table class="data"><tr><td>key {i}</td><td>Total</td></tr></table><section><ul><li>v{i}</li></ul></section>' for i in range(4)]
    assert len(h.templates(h.induce(a + b))) == 2
    got = wrapped(a + b)
    assert got[1] == "A1\ntext 1" and got[6] == "key 2\nv2"


def brute_match(a, b, x=0, y=0):
    if a.labels[x] != b.labels[y]:
        return 0
    p, q = list(a.kids[x].values()), list(b.kids[y].values())
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i in range(len(p)):
        for j in range(len(q)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_match(a, b, p[i], q[j]))
    return 1 + best[-1][-1]


def test_tree_matching_against_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        trees = []
        for _ in range(2):
            tags = [rng.choice(["div", "p", "ul", "li", "section", 'div class="a"', 'div class="b"', "h2", "td"]) for _ in range(rng.randint(1, 25))]
            html = "".join(f"<{t}>" + ("" if rng.random() < 0.5 else f"</{t.split()[0]}>") for t in tags)
            trees.append(h.Tree.of(h.Page(html))[0])
        a, b = trees
        n, met = h.match(a, b)
        assert n == len(met) == brute_match(a, b)
        for x, y in met.items():
            assert a.labels[x] == b.labels[y] and (x == y == 0 or met[a.parents[x]] == b.parents[y])


def test_extract(spark):
    long = "".join(f"<p>paragraph {k} of a long one</p><h3>h{k}</h3>" for k in range(3000))
    rows = [page("a.example", i, f"<article><h1>N{i}</h1><p>{'x' * i} body {i}</p><p>Thank you for reading.</p></article>") for i in range(40)]
    rows += [page("b.example", 50, "<article><h1>Only</h1><p>one</p></article>"), page("a.example", 51, f"<article>{long}</article>"), (52, "https://a.example/n", None), (53, "https://a.example/e", ""), (54, None, "<article><p>no url</p></article>"), page("a.example", 55, "<article></article>"), (56, "https://c.example", "<div><p>plain &#233;&nbsp; text</p>tail</div>"), page("a.example", 7, "<article><h1>N7</h1><p>again</p></article>"), (57, "https://a.example/deep", "<div>" * 5000 + "deep")]
    df = spark.createDataFrame([(i, u, t, "clash", "clash") for i, u, t in rows], "page_id long, url string, html string, wrapper string, host string").repartition(5)
    got = {}
    for r in h.extract(df).collect():
        assert r["n_chars"] == len(r["text"])
        got.setdefault(r["page_id"], []).append(r["text"])
    assert len(got) == 48 and sorted(got[7]) == ["N7\nagain", "N7\nxxxxxxx body 7"]
    assert got[3] == ["N3\nxxx body 3"] and got[50] == ["Only\none"] and got[52] == got[53] == got[55] == [""]
    assert got[54] == ["no url"] and got[56] == ["plain é text\ntail"] and got[51][0].count("\n") == 5999 and got[57] == ["deep"]


def test_broadcast_and_shuffle_agree(spark, monkeypatch):
    df = spark.createDataFrame([page(f"h{i % 3}.example", i, f"<article><p>t{i}</p><p>Same</p></article>") for i in range(30)], "page_id long, url string, html string")
    one = sorted(map(tuple, h.extract(df).collect()))
    monkeypatch.setattr(h, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, h.extract(df).collect())) == one and one[4][2] == "t4"


def test_empty(spark):
    assert h.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_all_articles_and_all_of_main_stay():
    whole = h.main_text("<body><nav><a href='/'>x</a></nav><main><h1>Title</h1><p>lead</p><article><p>one</p></article><ul><li><a href='/y'>menu</a></li></ul><article>two<p><a href='/z'>linked words</a></p></article></main><p>beside</p></body>")[0]
    assert whole == "Title\nlead\none\ntwo\nlinked words"
    assert h.main_text("<article><p>one</p></article><p>beside</p><article><p>two</p></article>")[0] == "one\ntwo"
    assert h.main_text("<main></main><article>x</article>")[0] in ("", "x")


def test_a_rare_layout_and_lines_beside_the_first_pages(spark):
    """Templates and constant lines come from all pages of a host: a layout of 6 of 600 pages teaches its lines."""
    rows = [page("a.example", i, f"<article><h1>N{i}</h1><p>body {i}</p></article>") for i in range(600)]
    rare = [(600 + i, f"https://a.example/r/{i}", f'<table class="data"><tr><td>key {i}</td><td>Total</td></tr></table><section><ul><li>v{i}</li></ul></section>') for i in range(6)]
    df = spark.createDataFrame([*rows, *rare], "page_id long, url string, html string").repartition(3)
    for sample in (1, h.SAMPLE):
        got = {r["page_id"]: r for r in h.extract(df, sample=sample).collect()}
        assert len(got) == 606 and all(r["aligned"] for r in got.values())
        assert [got[600 + i]["text"] for i in range(6)] == [f"key {i}\nv{i}" for i in range(6)]
    # a line that one of ten pages lacks is constant, whichever page the template was made from
    rows = [(i, f"https://b.example/{i}", f"<article><p>t{i}</p>" + ("<p>All rights reserved.</p>" if i else "<p>Other words.</p>") + "</article>") for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = [(k, {r["page_id"]: r["text"] for r in h.extract(df.withColumn("page_id", F.col("page_id") + k), sample=1).collect()}) for k in range(0, 40, 10)]
    assert all(got[k] == "t0\nOther words." and got[k + 5] == "t5" for k, got in found)
