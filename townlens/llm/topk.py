"""Exact top-k inner products by block-at-a-time pruning.

Vectors are cut into ranges of ids of BLOCK rows. A block keeps, for each component (a term), the largest and smallest
value; for a query, the sum over terms of the larger of q * max and q * min bounds every score in the block. A query
visits the blocks of its cell in the order of these bounds and scores them through the block's forward index (its rows)
until the next bound falls below its kth score; a bound equal to it is still visited, for ties go to the smaller id.

Queries are a stated set met against all rows. Bounds come first: the largest and smallest values of all blocks, a
hundredth of the table, meet the queries in cells of a chunk of queries and a pack of blocks, and name the best block of
each query. Scoring that block gives each query a kth score to start from. Then the bounds meet the queries again, and
only blocks that reach the kth score of some query of a chunk are sent to that chunk; there, a query visits those its own
bound admits. So what is moved grows with the rows and the surviving pairs of block and chunk, which search() returns;
no task holds more than a cell, and each cell returns k rows a query, of which the best k remain.

Defined cases: vectors that are null or hold a null or non-finite component take no part; vectors are only compared with
those of their own length (empty ones score 0); the query's own id is never a candidate; repeated rows are candidates of
their own and each repeated query row has its own result; scores outside the 64-bit range saturate; columns of other
names, whatever they are, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townlens.llm.common import written

#: Rows of a block, queries of a chunk, blocks of a scoring cell, blocks of a bound cell, chunks whose queries share a first visit.
BLOCK, CHUNK, GROUP_BLOCKS, BOUND_BLOCKS, FIRST_CHUNKS = 256, 4096, 256, 4096, 16
SCALE = 256


def _vectors(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
    """Ids and quantised vectors of the rows that take part."""
    column = batch.column("v")
    ids, out = batch.column("id").to_pylist(), []
    flat = column.flatten()
    sizes = np.diff(column.offsets.to_numpy())
    data = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    good = column.is_valid().to_numpy(zero_copy_only=False)
    at = 0
    for i, n in enumerate(sizes.tolist()):
        x = data[at : at + n]
        at += n
        if good[i] and ids[i] is not None and np.isfinite(x).all():
            out.append((ids[i], np.nan_to_num(np.floor(SCALE * x))))
    return out


def _packs(source: DataFrame, size: int, tag: str, bounds: bool) -> DataFrame:
    """Rows in the order of ids, size to a pack: (pack, dim, n, ids, data, high, low), written; high and low are the
    largest and smallest values of each component."""

    def run(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, {}

        def pack(dim):
            nonlocal seq
            rows = held.pop(dim)
            seq += 1
            ids = np.array([i for i, _ in rows], dtype=np.int64).tobytes()
            data = np.array([x for _, x in rows], dtype=np.float64).reshape(len(rows), dim)
            ends = (data.max(axis=0).tobytes(), data.min(axis=0).tobytes()) if bounds else (b"", b"")
            return pa.RecordBatch.from_arrays([pa.array([part * 1_000_000_007 + seq], pa.int64()), pa.array([dim], pa.int32()), pa.array([len(rows)], pa.int32()), *(pa.array([x], pa.binary()) for x in (ids, data.tobytes(), *ends))], ["pack", "dim", "n", "ids", "data", "high", "low"])

        for b in batches:
            for i, x in _vectors(b):
                held.setdefault(len(x), []).append((i, x))
                if len(held[len(x)]) >= size:
                    yield pack(len(x))
        for dim in list(held):
            yield pack(dim)

    return written(source.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(run, "pack long, dim int, n int, ids binary, data binary, high binary, low binary"), tag)


def _matrix(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, np.int64)
    return keys, np.frombuffer(data, np.float64).reshape(len(keys), dim)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products a @ b.T; floats are exact below 2^53."""
    dim = max(1, a.shape[1])
    big = (np.abs(a).max(initial=0) or 1) * (np.abs(b).max(initial=0) or 1) * dim
    if big < 2**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(v) for v in row] for row in a], dtype=object).reshape(a.shape) @ np.array([[int(v) for v in row] for row in b], dtype=object).reshape(b.shape).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The most that each query can score in each block."""
    bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    return bound + np.abs(bound) * 1e-9  # rounding can only raise a bound


def search_cell(qids: np.ndarray, queries: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(n, k) ids and scores of each query's best rows in the cell (id -1 where there are fewer), and block visits.
    floor: a score that k rows are known to reach, for each query; blocks below it are not visited."""
    n = len(qids)
    lowest = np.iinfo(np.int64).min
    best_s, best_i = np.full((n, k), lowest), np.full((n, k), -1, dtype=np.int64)
    filled = np.zeros((n, k), dtype=bool)
    floor = np.full(n, -np.inf) if floor is None else floor
    bound = _bounds(queries, np.array([m.max(axis=0) for _, m in blocks]), np.array([m.min(axis=0) for _, m in blocks]))
    order = np.argsort(-bound, axis=1, kind="stable")
    alive, visits = np.arange(n), 0
    for rank in range(len(blocks)):
        at = order[alive, rank]
        kth = np.maximum(np.where(filled[alive, -1], best_s[alive, -1], -np.inf), floor[alive])
        going = bound[alive, at] >= kth
        alive, at = alive[going], at[going]
        if not len(alive):
            break
        for k_block in np.unique(at):
            q = alive[at == k_block]
            keys, m = blocks[k_block]
            visits += len(q)
            scores = _product(queries[q], m)
            own = keys[None, :] == qids[q][:, None]
            all_s = np.concatenate([best_s[q], scores], axis=1)
            all_i = np.concatenate([best_i[q], np.broadcast_to(keys, scores.shape)], axis=1)
            ok = np.concatenate([filled[q], ~own], axis=1)
            ranked = np.lexsort((all_i, -np.maximum(all_s, lowest + 1), ~ok), axis=1)[:, :k]
            row = np.arange(len(q))[:, None]
            best_s[q], best_i[q], filled[q] = all_s[row, ranked], all_i[row, ranked], ok[row, ranked]
    return np.where(filled, best_i, -1), best_s, visits


def _rows(table: pa.Table, *names: str):
    return zip(*(table.column(c).to_pylist() for c in names))


def _bound_cells(blocks: DataFrame, queries: DataFrame, run, schema: str) -> DataFrame:
    """run(chunk, queries, blocks, high, low, floor) over cells of a chunk of queries and a pack of block bounds."""
    ends = blocks.select("pack", "dim", "high", "low")
    groups = max(1, -(-ends.count() // BOUND_BLOCKS))
    left = ends.join(queries.select(F.col("pack").alias("chunk"), "dim"), "dim").withColumn("group", F.pmod(F.xxhash64("pack"), F.lit(groups)))
    right = queries.select(F.col("pack").alias("chunk_"), "ids", "data", "dim", "floor").withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def cell(theirs, mine):
        out = []
        if theirs.num_rows:
            names = np.array(theirs.column("pack").to_pylist(), dtype=np.int64)
            high, low = (np.array([np.frombuffer(x, np.float64) for x in theirs.column(c).to_pylist()]) for c in ("high", "low"))
            for chunk, ids, data, dim, floor in _rows(mine, "chunk_", "ids", "data", "dim", "floor"):
                _, m = _matrix(ids, data, dim)
                high, low = high.reshape(len(names), dim), low.reshape(len(names), dim)
                for at in range(0, len(m), 256):
                    f = np.full(len(m), -np.inf) if floor is None else np.frombuffer(floor, np.float64)
                    out.append(run(chunk, at, names, _bounds(m[at : at + 256], high, low), f[at : at + 256]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[] for _ in schema.split(", ")]
        fields = [f.split() for f in schema.split(", ")]
        return pa.table({n: pa.array(c, pa.float64() if t == "double" else pa.int64()) for c, (n, t) in zip(columns, fields)})

    return left.groupBy("group", "chunk").cogroup(right.groupBy("cell", "chunk_")).applyInArrow(cell, schema)


def _first_scores(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(pack, floor): for each chunk the kth score of each query in its best block, as packed doubles."""

    def best(chunk, at, names, bound, _):
        top = bound.max(axis=1)
        # the smallest name among equal bounds, so that cells agree
        name = np.where(bound == top[:, None], names[None, :], np.iinfo(np.int64).max).min(axis=1)
        return np.full(len(top), chunk), np.arange(at, at + len(top)), name, top

    local = _bound_cells(blocks, queries.withColumn("floor", F.lit(None).cast("binary")), best, "chunk long, row long, block long, bound double")
    chosen = written(local.groupBy("chunk", "row").agg(F.max_by("block", F.struct("bound", -F.col("block"))).alias("block")), "first-blocks")

    def unpack(batches):
        for b in batches:
            for chunk, ids, data, dim in _rows(b, "pack", "ids", "data", "dim"):
                keys, m = _matrix(ids, data, dim)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk)), pa.array(np.arange(len(keys))), pa.array(keys), pa.array([x.tobytes() for x in m], pa.binary())], ["chunk", "row", "id", "vector"])

    single = queries.select("pack", "ids", "data", "dim").mapInArrow(unpack, "chunk long, row long, id long, vector binary")
    some = F.floor(F.pmod(F.xxhash64("chunk"), F.lit(1 << 20)) / FIRST_CHUNKS)
    asked = single.join(chosen, ["chunk", "row"]).withColumn("some", some)
    there = chosen.select(F.col("block").alias("pack"), some.alias("part")).distinct()
    held = blocks.join(there, "pack").select(F.col("pack").alias("block_"), "part", "dim", "ids", "data")

    def score(theirs, mine):
        out = {"chunk": [], "row": [], "kth": []}
        for ids, data, dim in _rows(theirs, "ids", "data", "dim"):
            cell = [_matrix(ids, data, dim)]
            rows = list(_rows(mine, "chunk", "row", "id", "vector"))
            for at in range(0, len(rows), CHUNK):
                some = rows[at : at + CHUNK]
                found, scores, _ = search_cell(np.array([r[2] for r in some]), np.array([np.frombuffer(r[3], np.float64) for r in some]).reshape(len(some), dim), cell, k)
                out["chunk"] += [r[0] for r in some]
                out["row"] += [r[1] for r in some]
                out["kth"] += np.where(found[:, -1] >= 0, scores[:, -1].astype(np.float64), -np.inf).tolist()
        return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), "row": pa.array(out["row"], pa.int64()), "kth": pa.array(out["kth"], pa.float64())})

    kth = held.groupBy("block_", "part").cogroup(asked.groupBy("block", "some")).applyInArrow(score, "chunk long, row long, kth double")
    lists = kth.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("row", "kth"))).alias("f"))  # CHUNK numbers at most

    def packed(batches):
        for b in batches:
            floors = [np.array([x["kth"] for x in f], dtype=np.float64) for f in b.column("f").to_pylist()]
            # a score is rounded to a double here: step below it, so that none that equals it is missed
            yield pa.RecordBatch.from_arrays([b.column("chunk"), pa.array([np.where(np.abs(f) >= 2.0**53, f - np.abs(f) * 1e-15, f).tobytes() for f in floors], pa.binary())], ["pack", "floor"])

    return lists.mapInArrow(packed, "pack long, floor binary")


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """The result of top_k, and the (block, chunk, visits) that bounds could not exclude."""
    spark = vectors.sparkSession
    source = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    blocks = _packs(source.select("id", "v"), BLOCK, "blocks", True)
    queries = _packs(source.filter("q").select("id", "v"), CHUNK, "queries", False).drop("high", "low")
    queries = written(queries.join(_first_scores(blocks, queries, k), "pack", "left"), "floored")

    def reach(chunk, at, names, bound, floor):
        n = (bound >= floor[:, None]).sum(axis=0)
        kept = np.nonzero(n)[0]
        return names[kept], np.full(len(kept), chunk), n[kept]

    met = _bound_cells(blocks, queries, reach, "block long, chunk long, n long").groupBy("block", "chunk").agg(F.sum("n").alias("visits"))
    met = written(met, "surviving")
    n_groups = max(1, -(-met.count() // GROUP_BLOCKS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    group = F.pmod(F.xxhash64("block"), F.lit(n_groups)).cast("int").alias("group")
    cells = met.select("block", "chunk", group)
    left = blocks.select(F.col("pack").alias("block"), "dim", "ids", "data").join(cells, "block")
    mine = cells.select(F.col("chunk").alias("pack"), F.col("group").alias("cell")).distinct()
    right = queries.join(mine, "pack").select("cell", F.col("pack").alias("chunk_"), "ids", "data", "dim", "floor")

    def run(theirs, mine):
        out = {"q": [], "query_id": [], "vec_id": [], "score": []}
        for chunk, ids, data, dim, floor in _rows(mine, "chunk_", "ids", "data", "dim", "floor"):
            qids, m = _matrix(ids, data, dim)
            held = list(_rows(theirs, "ids", "data"))
            for at in range(0, len(held), GROUP_BLOCKS):
                blocks_here = [_matrix(i, d, dim) for i, d in held[at : at + GROUP_BLOCKS]]
                found, scores, _ = search_cell(qids, m, blocks_here, k, None if floor is None else np.frombuffer(floor, np.float64))
                row, col = np.nonzero(found >= 0) if (found >= 0).any() else (np.zeros(0, int), np.zeros(0, int))
                out["q"].append(np.int64(chunk) * CHUNK + row)
                out["query_id"].append(qids[row])
                out["vec_id"].append(found[row, col])
                out["score"].append(scores[row, col])
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in out.items()})

    local = left.groupBy("group", "chunk").cogroup(right.groupBy("cell", "chunk_")).applyInArrow(run, "q long, query_id long, vec_id long, score long")
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), met


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each row of vectors that is_query holds for."""
    return search(vectors, is_query, k, id_col, vector)[0]
