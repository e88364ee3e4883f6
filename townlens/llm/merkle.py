"""Merkle manifest of a dataset: a leaf of each row, a tree of each group, a root over the groups, and a proof of each leaf.

`forest` numbers the rows of each tree and builds its nodes. Numbers come from one range partitioning: each partition counts
its rows of a tree, and the counts of the partitions before it are added. Nodes come in bands of BAND levels: a run of
2^BAND consecutive nodes is folded in one group, and only its top goes on to the next band, so that a tree of 10^10 leaves is
built in five groupings, no group of which exceeds 2^BAND rows. The nodes are written, a row for each run.

`proofs` gives each row the coordinates of the siblings it needs on its way through a band, found from its position and the
number of leaves alone, joins the materialised table of nodes, and takes, orders and concatenates them. The coordinates of a
row in one band all lie in one run, so they stay together in an array and are joined by their run: exploded into a row each they
would be moved eight times over (measured: 516 MB shuffled on 0.5 GB). What is above a band is proven for the band's tops alone
and handed down to the rows below by the same run, so no node near the root is asked for by every leaf. Roots of trees are
leaves of the tree over the groups, and their proofs are found in the same way.

H is the lowercase hex sha256 of its inputs, concatenated; every 2 consecutive nodes become one, a last single one becomes the
H of itself, and a lone leaf is its tree's root. Rows of a group are ordered by id, null ids first; rows of one id by their
leaf. Groups are ordered by bytes, the null one first. Null, empty and very long fields are told apart (`field`). An empty
table gives no rows. Further columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import numbered, written

#: Levels of a band: a task folds up to 2^BAND nodes at once.
BAND = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value with its length in bytes before it, or - for null: no two rows of fields give one string."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def node(*hashes: Column) -> Column:
    return F.sha2(F.concat(*hashes).cast("binary"), 256)


def tree_key(group: Column) -> Column:
    """Groups as strings that are never null and keep their order: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def steps(n: Column, band: int) -> Column:
    """Levels that are folded in a band that begins with n nodes of a tree: all that are left, or `band`."""
    left = F.length(F.bin(n - 1)) * F.when(n > 1, 1).otherwise(0)
    return F.least(left, F.lit(band)).cast("int")


def upwards(nodes: Column) -> Column:
    """The level above one."""
    at = F.sequence(F.lit(0), F.shiftright(F.size(nodes) - 1, 1))
    return F.transform(at, lambda i: node(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))))


def forest(leaves: DataFrame, band: int = BAND) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """(roots, bands) of the trees of leaves (tree, at, n, hash). roots: tree, hash. Each band is (rows, nodes): the rows
    (tree, at, n, ...) that it begins with, and the written table of its nodes, one row a run of up to 2^band rows: tree, run,
    and levels, the run's nodes from its first level to its top."""
    highest = leaves.agg(F.max("n")).head()[0] or 0
    rows, bands, roots = leaves, [], []
    while True:
        runs = rows.groupBy("tree", F.shiftright("at", band).alias("run"), "n").agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("found"))
        some = F.slice(F.array(*[F.lit(i) for i in range(band)]), F.lit(1), steps(F.col("n"), band))
        levels = F.aggregate(some, F.array(F.col("found.hash")), lambda acc, _: F.concat(acc, F.array(upwards(F.element_at(acc, -1)))))
        nodes = written(runs.select("tree", "run", "n", levels.alias("levels")), "nodes")
        bands.append((rows, nodes.select("tree", "run", "levels")))
        top = F.get(F.element_at("levels", -1), F.lit(0))
        tops = nodes.select("tree", F.col("run").alias("at"), F.expr(f"shiftright(n + {(1 << band) - 1}, {band})").alias("n"), top.alias("hash"))
        roots.append(tops.filter("n <= 1").select("tree", "hash"))
        if highest <= 1 << band:
            break
        highest = -(-highest >> band)
        rows = tops.filter("n > 1")
    every = roots[0]
    for more in roots[1:]:
        every = every.unionByName(more)
    return written(every, "roots"), bands


PATH = "array<struct<right:boolean,hash:string>>"


def coordinates(at: Column, n: Column, band: int) -> Column:
    """What a row needs of its run: for each level whether its node there is the right one of its pair, and the place of the
    sibling among the run's nodes of the level. A place past the last node means that there is no sibling."""
    levels = F.filter(F.array(*[F.lit(i) for i in range(band)]), lambda i: i < steps(n, band))
    place = lambda i: F.call_function("shiftright", at.bitwiseAND(F.lit((1 << band) - 1)).cast("int"), i)
    return F.transform(levels, lambda i: F.struct(i.alias("level"), (place(i).bitwiseAND(F.lit(1)) == 1).alias("right"), place(i).bitwiseXOR(F.lit(1)).alias("sibling")))


def proofs(bands: list[tuple[DataFrame, DataFrame]], band: int = BAND) -> DataFrame:
    """The rows of the trees with `path`: for each level up to the root, whether a row's node is the right one of its pair,
    and the sibling, null where there is none."""
    above = None
    for rows, nodes in reversed(bands):
        found = rows.withColumn("run", F.shiftright("at", band)).join(nodes, ["tree", "run"])
        path = F.transform(coordinates(F.col("at"), F.col("n"), band), lambda x: F.struct(x["right"].alias("right"), F.get(F.get(F.col("levels"), x["level"]), x["sibling"]).alias("hash")))
        found = found.withColumn("path", path).drop("levels")
        if above is not None:
            found = found.join(above, ["tree", "run"], "left").withColumn("path", F.concat("path", F.coalesce("upper", F.array().cast(PATH)))).drop("upper")
        above = found.select("tree", F.col("at").alias("run"), F.col("path").alias("upper"))
    return found.drop("run")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def up(acc: Column, x: Column) -> Column:
        other = F.coalesce(x["hash"], F.lit(""))
        return F.when(x["right"], node(other, acc)).otherwise(node(acc, other))

    return F.aggregate(path, start, up)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", id_col: str = "doc_id", band: int = BAND, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of docs: id, leaf, subroot (of its group), root and path, the siblings of its proof from the leaf
    over the subroot to the root. carry: further columns over docs to keep, by names that are none of these."""
    own = docs.select(docs[id_col].alias("id"), tree_key(docs[group]).alias("tree"), leaf(*[docs[c] for c in fields]).alias("hash"), *[c.alias(k) for k, c in (carry or {}).items()])
    roots, bands = forest(numbered(own, ["id", "hash"]), band)
    top, top_bands = forest(numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "hash"), ["of"]), band)
    over = proofs(top_bands, band).join(top.select("tree", F.col("hash").alias("root")), "tree")
    over = written(over.select(F.col("of").alias("tree"), F.col("hash").alias("subroot"), "root", F.col("path").alias("over")), "subroots")
    out = proofs(bands, band).join(over, "tree")
    return out.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot", "root", F.concat("path", "over").alias("path"), *(carry or {}))


def siblings(path: Column) -> Column:
    """The hashes of a proof, concatenated from the leaf to the root."""
    return F.array_join(F.filter(F.transform(path, lambda x: x["hash"]), lambda h: h.isNotNull()), "")


def tamper_report(docs: DataFrame) -> DataFrame:
    """The manifest with its proofs checked after tampering: where 7 divides the crc32 of the decimal id, n_chars is one
    more than was signed (a null stays, and so does the row of a null id)."""
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    changed = {c: docs[c] for c in FIELDS} | {"n_chars": docs["n_chars"].cast("long") + F.when(hit, 1).otherwise(0)}
    rows = manifest(docs, carry={"presented": leaf(*changed.values())})
    rows = rows.withColumn("folded_root", folded(F.col("presented"), F.col("path")))
    proof = node(siblings(F.col("path"))).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
