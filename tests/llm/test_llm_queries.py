import oracle
import pytest

from townlens.llm import queries, simhash

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": "doc_id held_out score predicted", "op2_": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op3_": "doc_id n_assign n_access n_hex base_sha256 spans", "op4_": "doc_id n_bytes n_tokens over_limit",
    "op6_": "page_id url text n_chars", "op7_": "query_id rank vec_id score", "op8_": "doc_id fingerprint component_id", "op10_": "doc_id start n_tokens ids_crc32",
    "op11_": "doc_id n_features weight score rank", "op12_": "doc_id n_bytes n_removed n_spans kept_sha256", "op13_": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_runs_with_the_columns_of_its_contract(spark, name):
    df = queries.queries()[name](spark, SF)
    want = next((v for k, v in COLUMNS.items() if name.startswith(k)), "")
    assert set(want.split()) <= set(df.columns)
    rows = df.count()
    if name.startswith(("op1_", "op2_", "op3_", "op4_", "op5_", "op8_", "op10_", "op11_", "op12_", "op13_")):
        assert rows == 200


def test_sql_twins(spark):
    con = oracle.connect(SF)
    for name, sql in queries.oracle_sql().items():
        assert oracle.differences(queries.queries()[name](spark, SF), con, sql) == ""


def test_simhash_on_the_table(spark):
    from test_simhash import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
