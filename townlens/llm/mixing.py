"""Mixing to target weights with soft domain membership, in DataFrame operations only.

A binned naive Bayes classifier learns from a labelled table which shape of text each domain has; its posterior makes
every document a soft member of all domains. Nonnegative rates r then minimise the squared residual |e|^2 of
sum_d r_d n_d p_dk against the target token total of each domain k by projected gradient: r <- max(floor, r + a.M.e) with
a_d = n_d p_d and residual e. At first M is the inverse of the Gram matrix sum_d a_d a_d^T, with which one is a safe and
fast step: a residual of zero is a minimum in any metric. Where a share of UNMET of the target is left after ROUNDS, rounds
go on as projected gradient on |e|^2 itself, with a step of a_d / |a_d| . e / L for each document, L the largest
eigenvalue of sum_d a_d a_d^T / |a_d|, until it no longer falls. `converged` says whether the rates that are left are a
minimum: the target is met, or no document has a slope left. Its slope is a_d / |a_d| . e / |e|, for a rate at the floor only
where it points upwards, and the largest over all documents is at most SLOPE (the conditions of Karush, Kuhn and Tucker).
Rounds may end before; then it is false. Each round is one aggregation; the driver holds one number for each domain
and round. The rate of a document depends on its token count and posterior bins only, so rounds run over the distinct
pairs with counts. Tokens are words; the domain is an enumeration of at most MAX_DOMAINS labels.

Defined cases: very long texts are split into words in one row; null and empty texts have no tokens, keep rate 1 and take no part; labels that are null or match no
document are not used; without usable labels the posterior is uniform and rates are those of one domain; repeated rows
are documents of their own; a target for which no domain has mass is left unmet (the residual says so); columns of other
names, whatever they are, are carried along by apply_mix and not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import narrow, written
from townlens.llm.spans import let

#: Rounds at most of the first kind and of the second; share of the target at which it counts as met, and fall of the squared
#: residual, as a share of the squared target, at which it counts as least.
ROUNDS, PLAIN_ROUNDS, TOLERANCE, UNMET, STILL = 40, 120, 1e-6, 1e-3, 1e-6
#: Slope of any document at which rates count as a minimum.
SLOPE = 1e-3
MAX_DOMAINS = 64
#: Bin edges of the features: share of signs, share of distinct words, mean word length.
EDGES = {
    "signs": (0.002, 0.01, 0.03, 0.08, 0.15, 0.25, 0.35),
    "variety": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95),
    "length": (2.5, 3.5, 4.5, 5.0, 5.5, 6.0, 7.0, 9.0, 14.0),
}
SIGNS = "[%$*&#!|]"


def features(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, one bin number for each feature); tokens are words."""
    # One projection each for words, measures and bins: a measure is compared with many edges but computed once.
    split = narrow(docs, id_col, text).select("doc_id", "text", F.array_remove(F.split("text", r"\s+"), "").alias("w"))
    n = F.size("w").cast("double")
    measured = split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_tokens"),
        F.when(n > 0, F.regexp_count("text", F.lit(SIGNS)) / F.length("text")).alias("v_signs"),
        F.when(n > 0, F.size(F.array_distinct("w")) / n).alias("v_variety"),
        F.when(n > 0, F.length("text") / n - 1).alias("v_length"),
    )
    return measured.select("doc_id", "n_tokens", *[F.when(F.col("n_tokens") == 0, 0).otherwise(_bin(F.col(f"v_{f}"), edges)).cast("int").alias(f) for f, edges in EDGES.items()])


def _bin(value: Column, edges: tuple[float, ...]) -> Column:
    out = F.lit(0)
    for e in edges:
        out = out + (value >= e).cast("int")
    return out


def fit(feats: DataFrame, labelled: DataFrame, id_col: str = "doc_id", domain: str = "quality") -> tuple[list, dict[str, np.ndarray]]:
    """The domains in order, and for each feature log P(bin | domain); under '' the log prior. All labels are used."""
    marks = labelled.select(labelled[id_col].alias("doc_id"), labelled[domain].alias("domain")).filter("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.max("domain").alias("domain"))
    if marks.select("domain").distinct().limit(MAX_DOMAINS + 1).count() > MAX_DOMAINS:
        raise ValueError(f"{domain} has more than {MAX_DOMAINS} labels")
    rows = feats.join(marks, "doc_id").groupBy("domain", *EDGES).agg(F.count("*").alias("n")).collect()  # bounded by the bins
    domains = sorted({r["domain"] for r in rows}) or [None]
    model = {"": np.zeros(len(domains))} | {f: np.full((len(domains), len(e) + 1), 0.5) for f, e in EDGES.items()}
    for r in rows:
        k = domains.index(r["domain"])
        model[""][k] += r["n"]
        for f in EDGES:
            model[f][k][r[f]] += r["n"]
    model[""] = np.log(model[""] + 1) - np.log(model[""].sum() + len(domains))
    for f in EDGES:
        model[f] = np.log(model[f] / model[f].sum(axis=1, keepdims=True))
    return domains, model


def posterior(model: dict[str, np.ndarray]) -> Column:
    """Array with the probability of each domain, from the bin columns."""
    logs = []
    for k in range(len(model[""])):
        total = F.lit(float(model[""][k]))
        for f in EDGES:
            total = total + F.element_at(F.array(*[F.lit(float(x)) for x in model[f][k]]), F.col(f) + 1)
        logs.append(total)
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    weights = F.array(*[F.exp(x - top) for x in logs])
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _rate(steps: list[np.ndarray], floor: float, mass: list[Column]) -> Column:
    """Projected steps in turn, from rate 1; steps[i] holds the move for each unit of mass in each domain, then the move
    for each unit of the direction of the mass."""
    rate = F.lit(max(1.0, floor))
    if not steps:
        return rate
    size = F.sqrt(sum((m * m for m in mass), F.lit(0.0)))
    history = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])

    def moves(x: Column) -> Column:
        """x: the mass in each domain and the direction of the mass, computed once for all steps."""

        def move(r: Column, s: Column) -> Column:
            out = r
            for k in range(2 * len(mass)):
                out = out + x[k] * F.element_at(s, k + 1)
            return F.greatest(F.lit(float(floor)), out)

        return F.aggregate(history, rate.cast("double"), move)

    return let(F.array(*mass, *[F.when(size > 0, m / size).otherwise(F.lit(0.0)) for m in mass]), moves)


def mix(docs: DataFrame, labelled: DataFrame, weights: dict | list[float] | None = None, budget: float | None = None, floor: float = 0.0, seed: int = 7, id_col: str = "doc_id", text: str = "text", domain: str = "quality") -> DataFrame:
    """(doc_id, n_tokens, posterior, rate, copies, domain_error, converged) for each row of docs.

    weights: share of the tokens that each domain should have, by its label (all equal by default). budget: tokens
    wanted; by default as many as there are, or with a floor of 1 or more as many as leave no domain short of what it
    has. copies is the rate rounded up or down by a hash of the id, so that its mean is the rate."""
    feats = written(features(docs, id_col, text), "features")
    domains, model = fit(feats, labelled, id_col, domain)
    soft = feats.withColumn("posterior", posterior(model))
    K = len(domains)
    mass = [F.col("n_tokens") * F.element_at("posterior", k + 1) for k in range(K)]
    classes = written(soft.groupBy("n_tokens", *EDGES).agg(F.count("*").alias("docs")).withColumn("posterior", posterior(model)), "mix-classes")
    size = F.sqrt(sum((m * m for m in mass), F.lit(0.0)))
    moments = classes.agg(*[F.coalesce(F.sum(F.col("docs") * mass[k]), F.lit(0.0)).alias(f"t{k}") for k in range(K)], *[F.coalesce(F.sum(F.col("docs") * mass[k] * mass[j]), F.lit(0.0)).alias(f"m{k}_{j}") for k in range(K) for j in range(K)], *[F.coalesce(F.sum(F.when(size > 0, F.col("docs") * mass[k] * mass[j] / size)), F.lit(0.0)).alias(f"u{k}_{j}") for k in range(K) for j in range(K)]).first()
    have = np.array([moments[f"t{k}"] for k in range(K)])
    gram = np.array([[moments[f"m{k}_{j}"] for j in range(K)] for k in range(K)])
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    if weights is None:
        share = np.full(K, 1 / K)
    else:
        share = np.array([weights.get(d, 0.0) for d in domains] if isinstance(weights, dict) else weights[:K], dtype=float)
        share = share / share.sum() if share.sum() > 0 else np.full(K, 1 / K)
    if budget is None:
        budget = max((h / s for h, s in zip(have, share) if s > 0), default=0.0) if floor >= 1 else have.sum()
    target = share * budget

    steps: list[np.ndarray] = []
    error, before, plain, residual = 0.0, np.inf, False, target
    flat = np.array([[moments[f"u{k}_{j}"] for j in range(K)] for k in range(K)])
    largest = float(np.linalg.eigvalsh(flat)[-1])
    for done in range(ROUNDS + PLAIN_ROUNDS):
        rate = _rate(steps, floor, mass)
        now = classes.agg(*[F.coalesce(F.sum(F.col("docs") * mass[k] * rate), F.lit(0.0)).alias(f"t{k}") for k in range(K)]).first()
        residual = target - np.array([now[f"t{k}"] for k in range(K)])
        error, square = float(np.abs(residual).sum() / max(1.0, target.sum())), float(residual @ residual)
        plain = done >= ROUNDS
        if done == ROUNDS and error < UNMET:
            break
        if error < TOLERANCE or largest <= 0 or (plain and before - square <= STILL * max(1.0, float(target @ target))):
            break
        before = square if plain else np.inf
        still = np.zeros(K)
        steps.append(np.concatenate([still, residual / largest] if plain else [inverse @ residual, still]))
    converged = error < TOLERANCE or largest <= 0
    if not converged:
        last = _rate(steps, floor, mass)
        slope = sum((m * float(e) for m, e in zip(mass, residual)), F.lit(0.0)) / size / float(np.linalg.norm(residual))
        left = F.when(size > 0, F.when(last > floor, F.abs(slope)).otherwise(F.greatest(slope, F.lit(0.0))))
        converged = (classes.agg(F.max(left)).head()[0] or 0.0) <= SLOPE
    rate = F.when(F.col("n_tokens") == 0, F.lit(1.0)).otherwise(_rate(steps, floor, mass))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rated = soft.withColumn("rate", rate)
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    return rated.select("doc_id", "n_tokens", "posterior", "rate", copies.cast("long").alias("copies"), F.lit(error).alias("domain_error"), F.lit(converged).alias("converged"))


def apply_mix(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs, each as often as its copies say; rows without an id stay once."""
    counts = mix(docs, labelled, id_col=id_col, **options).filter("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"))
    changed = written(counts.filter("_copies != 1"), "copies")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[id_col].alias("_key"))  # the columns of docs may have any name
    often = F.coalesce("_copies", F.lit(1)).cast("int")
    many = F.explode(F.when(often > 0, F.sequence(F.lit(1), often)).otherwise(F.array().cast("array<int>"))).alias("_copy")
    return rows.join(changed, F.col("_key") == F.col("_id"), "left").select("_row", many).select("_row.*")
