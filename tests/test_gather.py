import random

from pyspark.sql import functions as F

from townlens.operators import gather, reports

WEIGHTS = {"name": 4, "title": 4, "department": 2, "email": 5, "phone": 3, "phone_ext": 1, "address": 1, "hours": 1}
FIELDS = ("name", "title", "department", "email", "phone", "phone_ext", "address", "hours", "source_context")
SCHEMA = ", ".join(f"{f} string" for f in FIELDS) + ", confidence double, source_url string, seq long"


def brute_merge(rows):
    rich = lambda r: sum(w for f, w in WEIGHTS.items() if r[f])
    out = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        words = lambda x: " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in (x or "").lower()).split())
        key = ("email", r["email"].lower()) if r["email"] else ("row", words(r["name"]), words(r["title"] or r["department"]) or words(r["phone"]))
        old = out.get((r["source_url"], key))
        if old is None:
            out[r["source_url"], key] = dict(r)
            continue
        leads = rich(r) > rich(old) or (rich(r) == rich(old) and r["confidence"] >= old["confidence"])
        first, second = (r, old) if leads else (old, r)
        out[r["source_url"], key] = {f: first[f] or second[f] for f in FIELDS} | {"confidence": max(r["confidence"], old["confidence"]), "source_url": r["source_url"]}
    return sorted(tuple(str(v[f] or "") for f in FIELDS) + (round(v["confidence"], 6), v["source_url"]) for v in out.values())


def test_merge_against_brute_force(spark):
    rng, rows = random.Random(6), []
    for i in range(500):
        pick = lambda *v: rng.choice([None, None, *v])
        rows.append({"name": rng.choice(["Jane Doe", "jane  doe", "Bob Stone"]), "title": pick("Clerk", "Assessor"), "department": pick("Town Clerk"), "email": pick("a@t.gov", "A@t.gov", "b@t.gov"), "phone": pick("860", "203"), "phone_ext": pick("1"), "address": pick("1 Main"), "hours": pick("9-5"), "source_context": pick("x", "y"), "confidence": rng.choice([0.4, 0.5, 0.9]), "source_url": f"u{rng.randint(1, 12)}", "seq": i})
    df = spark.createDataFrame([tuple(r[k] for k in (*FIELDS, "confidence", "source_url", "seq")) for r in rows], SCHEMA).repartition(5)
    got = gather.merge_contacts(df).collect()
    assert sorted(tuple(str(r[f] or "") for f in FIELDS) + (round(r["confidence"], 6), r["source_url"]) for r in got) == brute_merge(rows)
    assert sum(r["sightings"] for r in got) == 500


def test_rows_that_name_nobody_go(spark):
    names = ["Jane Doe", "  Jane \n Doe ", None, "", "Vacant", "Email Jane", "Staff Directory", "123", "The Contact Person", "Contactless Joe"]
    df = spark.createDataFrame([(n, " Email Town  Clerk - ", None, " J@X.org ", " ", "", None, None, None, None, "u", i) for i, n in enumerate(names)], SCHEMA)
    got = gather.normalize_contacts(df).collect()
    assert [r["name"] for r in got] == ["Jane Doe", "Jane Doe", "Contactless Joe"]
    assert {(r["title"], r["email"], r["phone"], r["confidence"]) for r in got} == {("Town Clerk", "j@x.org", None, 0.45)}


def test_discovered_probes(spark):
    urls = ["https://t.org/staff-directory", "https://t.org/x.pdf?directory", "https://t.org/departments/tax.pdf", "https://other.org/directory", "https://t.org/news", "https://www.t.org/departments/assessor", "https://t.org/government", "https://t.org/building", "https://t.org/planning", None]
    rows = [("a", u, k) for u in urls for k in ("robots", "sitemap")]
    df = spark.createDataFrame(rows, "town string, url string, kind string").withColumn("domain", F.lit("t.org"))
    got = [r["url"] for r in gather.discovered_probes(df, "town", "domain").orderBy("place").collect()]
    assert len(got) == 4 and got[0] == "https://t.org/staff-directory" and "https://www.t.org/departments/assessor" in got
    assert not {"https://other.org/directory", "https://t.org/news", "https://t.org/departments/tax.pdf"} & set(got)


def test_missing_ids_and_statuses_of_unknown_towns(spark):
    towns = spark.createDataFrame([("a",), ("b",), ("c",)], "municipality_id string")
    there, gone = reports.missing_ids(spark.createDataFrame([("a",), ("x",), ("c",)], "municipality_id string"), towns)
    assert [r[0] for r in gone.collect()] == ["x"] and sorted(r[0] for r in there.collect()) == ["a", "c"]
    statuses = spark.createDataFrame([("a", 1, '{"hits": 1}'), ("a", 2, '{"hits": 3, "kind": "k"}'), ("b", 1, "not json"), ("z", 1, "{}")], "municipality_id string, seq long, value string")
    got = {r["municipality_id"]: (r["hits"], r["kind"]) for r in reports.recovery_status(towns, statuses, {"hits": "int", "kind": "string"}).collect()}
    assert got == {"a": (3, "k"), "b": (0, ""), "c": (0, "")}


def test_reasons_and_empty_tables(spark):
    df = spark.createDataFrame([("tax; permit",), ("tax",), (None,), ("",)], "reasons string")
    assert {r["reason"]: r["n"] for r in gather.reason_histogram(df).collect()} == {"tax": 2, "permit": 1}
    assert gather.merge_contacts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_files_of_a_run(spark, tmp_path):
    from townlens.sources import files

    full = spark.createDataFrame([("ct_a", "8605551234.0"), ("ct_b", None)], "municipality_id string, phone string")
    files.write_qa_set(spark, {files.QA_FILES[0]: full}, f"file://{tmp_path}/qa")
    read = lambda name: "".join(p.read_text() for p in sorted((tmp_path / "qa" / f"{name}.csv").glob("part-*")))
    assert read(files.QA_FILES[0]).splitlines() == ["municipality_id,phone", "ct_a,8605551234", "ct_b,"]
    assert all(read(name) == "" for name in files.QA_FILES[1:])
    files.write_json_lines(full, f"file://{tmp_path}/rows")
    assert spark.read.schema(full.schema).json(f"file://{tmp_path}/rows").count() == 2


def test_gate_and_api(spark):
    from townlens.operators import recovery

    probes = [("a", 1, recovery.EXTRACTABLE[0], "text/html; x", "y" * 600, 200, "/api"), ("a", 1, recovery.EXTRACTABLE[0], "text/html", "short", 200, "/x"), ("b", 0, recovery.EXTRACTABLE[0], "text/html", "y" * 600, 404, "/api"), ("c", 1, "none", "text/html", "openapi " * 90, 200, "/docs")]
    df = spark.createDataFrame(probes, "municipality_id string, hit int, category string, content_type string, text string, status int, path string")
    assert df.filter(recovery.extraction_gate()).count() == 1
    assert {r[0]: (r[1], r[2]) for r in recovery.api_presence(df).collect()} == {"a": (1, "rest_root"), "b": (0, "none"), "c": (1, "swagger")}
