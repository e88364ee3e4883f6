"""Importance resampling towards a target: documents are weighed by how much likelier their hashed word runs are in the
target than in the corpus, and drawn without replacement by weight plus Gumbel noise that is a function of the id.

Each text is scanned once (`scan`): a ring holds the crc32 states of the runs that the last n starts have begun, each new word
extends every state by a space and itself, and the states, modulo `buckets`, are what the scan emits; no run of words is ever
put together. The buckets are written, 16 bits each where they fit; counts and weights are made from them.

Words are runs of digits, letters a-z (A-Z in lower case) and all that is not ASCII. A null or empty text has none, and weight 0.
Very long texts take four bytes a feature in their task. Ids repeat or are null as they like: the noise of rows that share an
id is the same, null ids hash as an empty one and come first among ties, and equal rows rank in any order. With an empty corpus
or target the counts are 0 and the weights follow from them. Further columns are ignored."""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import forget, narrow, numbered, written

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Production parameters: longest run in words, buckets, hundredths of the eligible documents drawn, fewest words of one that
#: may be drawn, seed of the noise. The driver holds one number a bucket, so buckets have a limit.
RUN, BUCKETS, SHARE, LEAST_WORDS, SEED, MOST_BUCKETS = 2, 10_000, 25, 20, 7, 1 << 20


def scan(text: bytes, run: int) -> tuple[int, array]:
    """(words, crc32 of every run of 1 to `run` words) of a text in one pass, longest state first dropped."""
    ring: list[int] = []
    found, words = array("I"), 0
    for m in WORD.finditer(text.lower()):
        word = m[0]
        spaced = b" " + word
        ring = [crc32(word), *[crc32(spaced, state) for state in ring[: run - 1]]]
        found.extend(ring)
        words += 1
    return words, found


SCANNED = "doc_id long, words long, n_features long, buckets binary"


def scanned(docs: DataFrame, run: int, buckets: int) -> DataFrame:
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            words, features, data = [], [], []
            for x in rows["text"]:
                n, found = scan(x.as_py().encode(), run)
                words.append(n)
                features.append(len(found))
                data.append((np.frombuffer(found, np.uint32) % np.uint32(buckets)).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "words", "n_features", "buckets"])

    return docs.mapInArrow(go, SCANNED)


def counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket. Tasks count their own; the driver gets one number a bucket."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for rows in batches:
            for x in rows["buckets"]:
                total += np.bincount(np.frombuffer(x.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, object)
    for bucket, n in found.select("buckets").mapInArrow(go, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket floor(1000 * ln of the smoothed rate in the target over that in the corpus)."""
    size, s_all, t_all = len(corpus), int(sum(corpus)), int(sum(target))
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))) for s, t in zip(map(int, corpus), map(int, target))], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of the hash of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, words, n_features, weight (floored mean gain of the features, 0 without) and score (weight plus noise)."""
    if not 0 < buckets <= MOST_BUCKETS or run < 1:
        raise ValueError(f"run is at least 1 and buckets are 1 to {MOST_BUCKETS}")
    rows = narrow(docs, id_col, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(target[target_text].cast("string"), F.lit("")).alias("text"))
    found = written(scanned(rows, run, buckets), "buckets")
    gain = gains(counts(found, buckets), counts(scanned(wanted, run, buckets), buckets))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            weight = [int(gain[np.frombuffer(b, kind)].sum()) // n if n else 0 for b, n in zip((b.as_py() for b in x["buckets"]), x["n_features"].to_pylist())]
            score = [w + noise(seed, i) for w, i in zip(weight, x["doc_id"].to_pylist())]
            yield pa.RecordBatch.from_arrays([x["doc_id"], x["words"], x["n_features"], pa.array(weight, pa.int64()), pa.array(score, pa.int64())], ["doc_id", "words", "n_features", "weight", "score"])

    out = written(found.mapInArrow(go, "doc_id long, words long, n_features long, weight long, score long"), "scores")
    forget(found)
    return out


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, **how) -> DataFrame:
    """weigh() with rank: 1, 2, 3... by falling score, ties to the smaller id, for the share (in hundredths, rounded down) of
    the documents with enough words that is drawn; null for all others."""
    weighed = weigh(docs, target, **how)
    may = F.col("words") >= least_words
    placed = numbered(weighed.filter(may).withColumns({"tree": F.lit(""), "falling": -F.col("score"), "row": F.monotonically_increasing_id()}), ["falling", "doc_id", "row"])
    rank = F.when(F.col("at") < F.floor(F.col("n") * share / 100), F.col("at") + 1)
    names = weighed.columns
    return placed.select(*names, rank.alias("rank")).unionByName(weighed.filter(~may).withColumn("rank", F.lit(None).cast("long")))
