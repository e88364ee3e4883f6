import json

from townlens.operators.recovery_rows import FIELDS, recovery_rows

LOG = "municipality_id string, seq int, value string"


def test_payload_then_notes_then_defaults(spark):
    blocked = spark.createDataFrame([("a", "b1", "http_forbidden"), ("b", None, "rate_limited"), ("c", "b3", ""), ("d", "b4", "x")], "municipality_id string, batch_id string, blocked_reason string")
    said = {"batch_id": "", "recovery_mode_attempted": True, "recovery_result": "partial_recovery", "deep_path_hits": 0, "deep_hit_tax": "2.9", "api_inventory_paths": "/a,,/b", "playwright_success": 1, "deep_path_trust": "High", "notes": "api_type=swagger;deep_path_hits=9;directory_hit=1;known_path_hits=4; first_deep_path=/p"}
    statuses = [("a", 1, json.dumps({"recovery_result": "discovery_failure"})), ("a", 2, json.dumps(said)), ("b", 1, "no json"), ("c", 1, None), ("z", 1, json.dumps(said)), ("d", 1, json.dumps({"recovery_result": "odd", "api_type": "odd", "notes": "x"}))]
    inventories = [("a", 1, json.dumps({"documented_get_count": 7, "best_endpoint_path": "/staff", "selected_probe_count": ""})), ("b", 2, "[]")]
    rows = {r["municipality_id"]: r for r in recovery_rows(blocked, spark.createDataFrame(statuses, LOG), spark.createDataFrame(inventories, LOG)).collect()}
    assert set(rows) == {"a", "b", "c", "d"} and list(rows["a"].asDict())[1:] == list(FIELDS)
    a = rows["a"]
    assert (a["batch_id"], a["recovery_mode_attempted"], a["recovery_result"], a["deep_path_hits"], a["deep_hit_tax"]) == ("b1", "true", "partial_recovery", 0, 2)
    assert (a["api_type"], a["api_hit"], a["api_endpoint_count"], a["playwright_attempted"], a["deep_path_trust"], a["directory_hit"], a["known_path_hits"], a["first_deep_path"]) == ("swagger", 1, 2, 1, "high", 1, 0, "/p")
    assert (a["documented_get_count"], a["best_api_endpoint"], a["selected_api_probe_count"]) == (7, "/staff", 0)
    for t in "bc":
        brought = {"batch_id": rows[t]["batch_id"], "blocked_reason": rows[t]["blocked_reason"]}
        assert {f: rows[t][f] for f in FIELDS} == FIELDS | brought
    assert (rows["b"]["batch_id"], rows["b"]["blocked_reason"]) == ("", "rate_limited")
    assert (rows["d"]["recovery_result"], rows["d"]["api_type"], rows["d"]["notes"]) == ("", "none", "x")


def test_empty_tables(spark):
    none = spark.createDataFrame([], LOG)
    blocked = spark.createDataFrame([], "municipality_id string, batch_id string, blocked_reason string")
    assert recovery_rows(blocked, none, none).count() == 0
