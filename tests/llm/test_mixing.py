import random

import numpy as np
import pytest

from townlens.llm import mixing

rng = random.Random(2)


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = [], []
    for i in range(600):
        low = i % 4 == 0
        words = [rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(rng.randint(5, 200))]
        docs.append((i, " ".join(f"{w}%%%" if low and rng.random() < 0.8 else w for w in words), "x"))
        if i % 2 == 0:
            labels.append((i, int(not low) if rng.random() > 0.05 else int(low), None))
    docs += [(700, "", "y"), (701, None, None), (702, "word " * 30_000, "y"), (None, "a b", "y"), (3, docs[3][1], "again")]
    labels += [(None, 1, None), (5, None, None), (9999, 0, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, rate string").repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, text string")


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_expected_totals_meet_targets(tables, floor):
    rows = mixing.mix(*tables, weights={0: 0.25, 1: 0.75}, floor=floor).collect()
    assert len(rows) == 605 and all(r["rate"] >= floor and abs(sum(r["posterior"]) - 1) < 1e-9 for r in rows)
    totals = sum(r["rate"] * r["n_tokens"] * np.array(r["posterior"]) for r in rows)
    assert totals[0] / totals.sum() == pytest.approx(0.25, abs=1e-3) and rows[0]["domain_error"] < 1e-3
    assert all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in rows)
    guess = [r["posterior"][0] > 0.5 for r in rows if r["doc_id"] is not None and r["doc_id"] < 600]
    truth = [r["doc_id"] % 4 == 0 for r in rows if r["doc_id"] is not None and r["doc_id"] < 600]
    assert np.mean(np.array(guess) == np.array(truth)) > 0.9


def test_rates_are_those_of_plain_projected_gradient(tables):
    rows = mixing.mix(*tables, weights={0: 0.9, 1: 0.1}).collect()
    a = np.array([r["n_tokens"] * np.array(r["posterior"]) for r in rows])
    target = np.array([0.9, 0.1]) * a.sum()
    size = np.linalg.norm(a, axis=1, keepdims=True)
    unit = np.divide(a, size, out=np.zeros_like(a), where=size > 0)
    m, r, before = np.linalg.pinv(a.T @ a, rcond=1e-9), np.ones(len(a)), np.inf
    for done in range(mixing.ROUNDS + mixing.PLAIN_ROUNDS):
        e = target - a.T @ r
        error = np.abs(e).sum() / target.sum()
        if error < mixing.TOLERANCE or (done == mixing.ROUNDS and error < mixing.UNMET):
            break
        if done < mixing.ROUNDS:
            r = np.maximum(0, r + a @ (m @ e))
        else:
            if before - e @ e <= mixing.STILL * (target @ target):
                break
            before = e @ e
            r = np.maximum(0, r + unit @ e / np.linalg.eigvalsh(a.T @ unit)[-1])
    r[[x["n_tokens"] == 0 for x in rows]] = 1
    assert np.allclose(r, [x["rate"] for x in rows], rtol=1e-6, atol=1e-6)


def test_targets_that_cannot_be_met_are_met_in_least_squares(tables):
    """No document belongs to one domain alone, so shares of one and nothing are out of reach."""
    for weights in ({0: 1.0, 1: 0.0}, {0: 0.0, 1: 1.0}):
        rows = mixing.mix(*tables, weights=weights).collect()
        a = np.array([r["n_tokens"] * np.array(r["posterior"]) for r in rows])
        target = np.array([weights[0], weights[1]]) * a.sum()
        # the cone of the documents' directions is spanned by its two edges; the best point lies on one of them
        best = min(np.sum((target - v * max(0.0, v @ target / (v @ v))) ** 2) for v in a[a.sum(axis=1) > 0])
        got = sum(r["rate"] * x for r, x in zip(rows, a))
        # rounds end where the residual falls too slowly to matter: within two percent of the target of the least one
        assert np.linalg.norm(target - got) <= best**0.5 + 0.02 * np.linalg.norm(target)


def test_held_out_domains(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.filter("crc32(cast(doc_id as string)) % 3 <> 1")
    rows = mixing.mix(docs, seen, weights={0: 0.1, 1: 0.9}).join(labels.join(seen.select("doc_id"), "doc_id", "left_anti"), "doc_id").collect()
    right = [(r["posterior"][1] > 0.5) == (r["quality"] == 1) for r in rows]
    assert len(right) > 900 and np.mean(right) > 0.85


def test_apply(tables):
    docs, labels = tables
    out = mixing.apply_mix(docs, labels, weights={0: 0.2, 1: 0.8}, floor=1.0)
    assert out.columns == docs.columns
    odd = docs.withColumnsRenamed({"text": "_copies", "rate": "_row"})
    assert mixing.apply_mix(odd, labels, text="_copies", weights={0: 0.2, 1: 0.8}, floor=1.0).columns == odd.columns
    ids = {r["doc_id"] for r in out.collect()}
    assert ids == {r["doc_id"] for r in docs.collect()} and out.count() > docs.count()


def test_empty_and_unlabelled(tables):
    docs, labels = tables
    assert mixing.mix(docs.limit(0), labels).count() == 0
    assert {r["rate"] for r in mixing.mix(docs, labels.limit(0)).collect()} == {1.0}
    assert mixing.apply_mix(docs, labels.limit(0)).count() == docs.count()
