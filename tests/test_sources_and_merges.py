import csv
import json

import pytest
from pyspark.sql import functions as F

from townlens.functions import text as t
from townlens.functions import urls
from townlens.operators import extract, merge, recovery
from townlens.sources import files
from townlens.streaming import upserts

FIELDS = "contact_id string, municipality_id string, email string, name string, title string, department string, email_type string, phone string, phone_ext string, address string, hours string, source_context string, source_url string, confidence double, seq long"
ORDER = [c.split()[0] for c in FIELDS.split(", ")]


def sighting(key, seq, conf, **over):
    row = dict.fromkeys(ORDER) | {"contact_id": key, "seq": seq, "confidence": conf} | over
    return tuple(row[c] for c in ORDER)


def fold(rows):
    """The statement an upsert runs, one row after the other."""
    state = {}
    for r in sorted((dict(zip(ORDER, x)) for x in rows), key=lambda r: r["seq"]):
        old = state.setdefault(r["contact_id"], r)
        if old is r:
            continue
        new = dict(old)
        wins = None not in (r["confidence"], old["confidence"]) and r["confidence"] >= old["confidence"]
        for f in merge.CONTACT_FIELDS:
            if old[f] is None or wins or (f == "email_type" and old[f] in ("", "unknown")):
                new[f] = r[f] if r[f] is not None else old[f]
        new["confidence"] = None if None in (r["confidence"], old["confidence"]) else max(r["confidence"], old["confidence"])
        state[r["contact_id"]] = new
    return state


ROWS = [sighting("a", 1, 0.5, name="Jane", email="j@x"), sighting("a", 2, 0.4, name="Janet", title="Clerk", email="other@x"), sighting("a", 3, 0.6, name=None, phone="1", email_type="direct"), sighting("b", 4, None, name="Bob"), sighting("b", 5, 0.9, name="Rob", hours="9-5"), sighting("c", 6, 0.1, email_type="unknown"), sighting("c", 7, 0.0, email_type="role_based"), sighting("d", 8, 0.3, name="")]


def test_upsert_is_the_ordered_fold(spark):
    got = {r["contact_id"]: r.asDict() for r in merge.upsert_contacts(spark.createDataFrame(ROWS, FIELDS).repartition(4)).collect()}
    want = fold(ROWS)
    assert got == {k: {c: v[c] for c in got[k]} for k, v in want.items()}


def test_stream_of_batches_equals_one_merge(spark, tmp_path):
    folder, schema = tmp_path / "in", spark.createDataFrame([], FIELDS).schema
    for i, part in enumerate((ROWS[:3], ROWS[3:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        upserts.merge_stream(stream, str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination(60)
    state, last = upserts.current(spark, str(tmp_path / "state"), schema)
    want = fold(ROWS)
    assert last >= 1 and {r["contact_id"]: (r["name"], r["confidence"]) for r in state.collect()} == {k: (v["name"], v["confidence"]) for k, v in want.items()}


def test_other_merges(spark):
    pages = spark.createDataFrame([("p", "m", "u", "a", "T", None, 1), ("p", "m2", "u2", "b", None, "d", 2)], "page_id string, municipality_id string, url string, page_type string, title string, discovered_from string, seq long")
    assert merge.upsert_pages(pages).first().asDict() == {"page_id": "p", "municipality_id": "m", "url": "u", "title": "T", "discovered_from": "d", "page_type": "b"}
    seen = spark.createDataFrame([("k", None, "x", 0.2, 1), ("k", "n", "y", 0.7, 2)], "key string, name string, title string, confidence double, seq long")
    assert merge.merge_sightings(seen, ["key"], ("name", "title")).first().asDict() == {"key": "k", "name": "n", "title": "x", "confidence": 0.7, "sightings": 2}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_scalars(spark):
    for raw, want in (("8.6E+09", "8600000000"), ("2.04e9", "2040000000"), ("0123456789", "0123456789"), ("NaN", ""), ("8605551000.0", "8605551000"), (None, ""), (" 12 ", "12"), ("1.50e1", "15")):
        assert one(spark, t.safe_phone(F.lit(raw))) == want
    for mail, want in (("bldgofficial@t.gov", "role_based"), ("taxcollector@t.gov", "role_based"), ("john.smith@t.gov", "direct"), (None, "unknown"), ("j.x@t", "unknown"), ("jsmith2@t", "direct")):
        assert one(spark, extract.email_type(F.lit(mail))) == want
    for url, label, want in (("https://t.gov/first-selectman", "", "official_page"), ("https://t.gov/town-clerk", "", "department_page"), ("https://t.gov/staff-directory", "", "directory_page"), ("https://t.gov/pay-taxes-online", "", "service_page"), ("https://t.gov/x", "", "candidate")):
        assert one(spark, extract.page_class(F.lit(url), F.lit(label))) == want
    assert one(spark, extract.page_class(F.lit("https://t.gov/animal-control"), F.lit(""), F.lit("directory_page"))) == "directory_category_page"
    jobs = one(spark, extract.service_class(F.lit("https://www.governmentjobs.com/jobs/chesterct"), F.lit("jobs url")))
    assert jobs["category"] == "jobs" and one(spark, extract.vendor(F.lit("https://www.governmentjobs.com/x"), F.lit(None)))["confidence"] >= 0.9
    assert one(spark, extract.service_class(F.lit("https://t.gov/Calendar.aspx?EID=370"), F.lit("Zoning Board Meeting CANCELLED")))["category"] != "permits"
    assert one(spark, urls.domain(F.lit("https://WWW.T.gov:8080/a"))) == "t.gov:8080" and one(spark, urls.normalized_path(F.lit("https://t.gov//A%20b/"))) == "/a b"
    assert one(spark, t.make_id("ctc", F.lit(" Ct_X "), F.lit(None))).startswith("ctc_")


def test_notes_and_endpoints(spark):
    notes = "api_hit=1;api_type=swagger; Deep_path_hits = 3;best_api_endpoint_class=contact_like;api_hit=7"
    assert one(spark, recovery.note_int(F.lit(notes), "api_hit")) == 1 and one(spark, recovery.note_enum(F.lit(notes), "api_type", recovery.API_TYPES, "none")) == "swagger"
    doc = json.dumps({"paths": {"/api/directory": {"get": {"summary": "Staff", "tags": ["Directory"]}}, "/api/auth/login": {"get": {"summary": "x"}}, "/api/staff/{id}": {"get": {}}, "/api/post": {"post": {}}}})
    found = recovery.swagger_endpoints(spark.createDataFrame([("m", doc), ("n", "not json")], "municipality_id string, text string"))
    assert found.count() == 3 and [r["path"] for r in recovery.select_endpoints(found).collect()] == ["/api/directory"]


def test_trust(spark):
    rows = [("a", "/town-clerk", "clerk", 1, "the clerk", 2), ("b", "/12/x", "clerk", 1, "old", 0), ("c", "/x", "tax", 0, "", 0)]
    df = spark.createDataFrame(rows, "municipality_id string, path string, category string, hit int, text string, extracted int")
    assert {tuple(r) for r in recovery.trust(df, {"clerk": ("clerk",)}, ("archive",)).collect()} == {("a", "high", 0), ("b", "low", 1), ("c", "none", 0)}


def test_files(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("﻿municipality_id,name,county,domain,platform\nct_a, Town A ,X,T.GOV,CivicPlus\n,No id,X,,\nct_b,Town B,Y,b.gov,\n", encoding="utf-8")
    seed = files.read_seed(spark, str(path))
    assert [(r["municipality_id"], r["domain"]) for r in seed.orderBy("municipality_id").collect()] == [("ct_a", "t.gov"), ("ct_b", "b.gov")]
    made = files.manifest_of(seed, "civicplus", "batch_9")
    assert made.columns == list(files.MANIFEST) and made.first()["municipality_id"] == "ct_a"
    assert files.manifest_of(seed, "civicplus", "b", exclude=True, keep_blank=False).count() == 0
    mine, others = files.split_by_platform(made.unionByName(made.withColumn("municipality_id", F.lit("ct_b"))), files.platform_map(seed), "CivicPlus")
    assert (mine.count(), others.count()) == (1, 1)
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        files.read_manifest(spark, str(bad))
    assert files.read_csv(spark, str(tmp_path / "none.csv"), "a string").count() == 0
    files.write_csv(spark.createDataFrame([("x", "8.6E+09")], "name string, phone string"), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*.csv"))
    assert list(csv.reader(part.open())) == [["name", "phone"], ["x", "8600000000"]]
    site = spark.createDataFrame([("<urlset><loc> https://a/b </loc><loc>https://c</loc></urlset>", "User-agent: *\nDisallow: /x/\nAllow: /y\nDisallow: /*.pdf$")], "text string, robots string")
    assert [r["url"] for r in files.sitemap_urls(site).collect()] == ["https://a/b", "https://c"]
    assert [r["path"] for r in files.robots_paths(site, "robots").collect()] == ["/x/", "/y"]
    assert set(files.with_missing_columns(site, {"z": "int"}).columns) == {"text", "robots", "z"}
