import random

from townlens.operators import recovery

SCHEMA = "municipality_id string, phase string, ordinal int, url string, path string, category string, status int, hit int, content_type string, text string, contacts int"


def walk(rows, budget=10, deep_budget=20):
    """One town, attempt by attempt."""
    out, streak, used, seen_urls, seen_paths, deep_streak, deep_used, contacts = {}, 0, 0, set(), set(), 0, 0, 0
    refused = lambda r: r[6] in (403, 429)
    order = {k: i for i, k in enumerate(recovery.DEEP_ORDER)}
    rows = sorted((r for r in rows if r[1] in recovery.PHASES), key=lambda r: (recovery.PHASES.index(r[1]), order.get((r[5] or "").lower(), 8) if r[1] == "deep" else 0, r[2]))
    discovered = 0
    for r in rows:
        key = (r[1], r[2])
        if r[1] == "api":
            out[key] = "done"
        elif r[1] == "deep":
            path = (r[4] or "").strip().lower()
            path = path if path == "/" else path.rstrip("/")
            if path in seen_paths:
                out[key] = "duplicate"
                continue
            seen_paths.add(path)
            deep_used += 1
            if deep_used > deep_budget:
                out[key] = "over_budget"
            elif deep_streak >= 3:
                out[key] = "blocked"
            elif contacts >= 10:
                out[key] = "enough_contacts"
            else:
                out[key] = "done"
                deep_streak = deep_streak + 1 if refused(r) else 0
                if r[7] == 1 and (r[5] or "").lower() in recovery.EXTRACTABLE and "html" in (r[8] or "").lower() and len(r[9] or "") >= 500:
                    contacts += r[10] or 0
        else:
            if r[1] == "discovered":
                discovered += 1
                if discovered > 4:
                    out[key] = "over_limit"
                    continue
            if r[1] in ("discovered", "known"):
                if r[3] is not None and r[3] in seen_urls:
                    out[key] = "duplicate"
                    continue
                seen_urls.add(r[3])
                used += 1
                if used > budget:
                    out[key] = "over_budget"
                    continue
            if streak >= 3:
                out[key] = "blocked"
            else:
                out[key] = "done"
                streak = streak + 1 if refused(r) else 0
    return out, [k for k in ((r[1], r[2]) for r in rows) if out[k] == "done"]


def test_plans_equal_a_walk_through_the_phases(spark):
    rng = random.Random(8)
    rows = []
    for t in range(40):
        for phase in (*recovery.PHASES, "other"):
            n = {"deep": 30, "known": 14, "discovered": 7, "home": 1, "sitemap": 1, "robots": 1, "fallback": rng.choice([0, 1])}.get(phase, 3)
            for i in range(n):
                status = rng.choice([200, 200, 403, 429, None] if t % 3 else [200, 404])
                rows.append((f"t{t}", phase, i, rng.choice([None, *[f"u{k}" for k in range(20)]]) if phase in ("discovered", "known") else "h", rng.choice(["/A", "/a/", "/b", "/", None, *[f"/p{k}" for k in range(30)]]), rng.choice([*recovery.DEEP_ORDER, "Tax", "odd", None]), status, int(status == 200), rng.choice(["text/HTML", "x", None]), "y" * rng.choice([0, 499, 500, 900]), rng.choice([None, 0, 1, 6])))
    got = recovery.recovery_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for t in range(40):
        want, places = walk([r for r in rows if r[0] == f"t{t}"])
        own = [r for r in got if r["municipality_id"] == f"t{t}"]
        assert {(r["phase"], r["ordinal"]): r["outcome"] for r in own if r["phase"] != "other"} == want
        assert [(r["phase"], r["ordinal"]) for r in sorted((r for r in own if r["place"]), key=lambda r: r["place"])] == places
        assert {r["outcome"] for r in own if r["phase"] == "other"} == {"unknown_phase"}


def test_a_run_of_refusals_at_home_counts_with_the_sitemap_and_not_with_deep_paths(spark):
    rows = [("t", p, i, f"{p}{i}", f"/{p}{i}", "tax", s, int(s == 200), "text/html", "z" * 600, 0) for p, i, s in [("home", 0, 403), ("fallback", 0, 429), ("api", 0, 403), ("deep", 0, 200), ("sitemap", 0, 403), ("robots", 0, 200), ("known", 0, 200)]]
    got = {r["phase"]: r["outcome"] for r in recovery.recovery_plan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"home": "done", "fallback": "done", "api": "done", "deep": "done", "sitemap": "done", "robots": "blocked", "known": "blocked"}
    assert recovery.recovery_plan(spark.createDataFrame([], SCHEMA)).count() == 0
