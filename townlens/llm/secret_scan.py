"""Secrets: base patterns, and multipart credential linking in DataFrame operations only.

A credential often comes in parts: an access identifier, a secret, an endpoint. Weak candidates (a short or oddly named
secret, a mixed token of 20 characters) say little alone; they are reported, as kind `linked`, only when an identifier
(an access key id, a user or account, a mail address) and an endpoint (an address with a scheme, a host, an IP address)
lie within SCOPE code points. Parts of one text are interval-joined: each weak candidate looks into the
buckets of SCOPE code points that its scope touches, a part lies in each bucket from its start to its end, and the join
keeps those within reach. Only texts with all three kinds of part send any, and a semi join emits no pairs.

Defined cases: null is empty; empty has no spans; repeated rows each have their own result; rows without an id are kept;
a candidate that holds a base secret is reported as that alone; columns of other names, whatever they are, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import narrow, written
from townlens.llm.spans import matches, spans, tagged

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Fixed patterns of the base kinds, in the order of the report; a run of 16 or 18 that is the longest at its place is
#: the same as a run that is measured afterwards.
KINDS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{14,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{16,}+",
}
PARTS = {
    "identifier": r"""AKIA[A-Z0-9]{4,}+|(?i:\b(?:access_?key(?:_?id)?|client_?id|user(?:_?name)?|login|account))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}+|(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++""",
    "weak": r"""(?i:\b(?:password|passwd|passphrase|pwd|pass|secret(?:_?key)?|token|api_?key|auth|credential))["']?\x20*[:=]\x20*["']?[^\s"',;]{4,}+|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9A-Z+/_-]*+[a-z])[A-Za-z0-9+/_-]{20,}+(?![A-Za-z0-9+/_-])""",
    "endpoint": r"""(?i:https?|jdbc:[a-z]++|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|ssh)://[^\s"'<>]++|(?i:\b(?:host|endpoint|server|url|region|bucket))["']?\x20*[:=]\x20*["']?[^\s"',;]{3,}+|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}+(?![0-9.])""",
}
SCOPE = 300


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over the texts: (doc_id, row, spans of the base kinds, spans of the parts)."""
    df = narrow(docs, id_col, text)
    df = df.select("doc_id", "text", *[matches(F.col("text"), p).alias(f"m_{k}") for k, p in KINDS.items()], *[matches(F.col("text"), PARTS[k]).alias(f"m_{k}") for k in ("identifier", "endpoint")])
    all_parts = (F.size("m_identifier") > 0) & (F.size("m_endpoint") > 0)
    df = df.withColumn("m_weak", F.when(all_parts, matches(F.col("text"), PARTS["weak"])).otherwise(F.array().cast("array<string>")))
    for k in ("identifier", "endpoint"):
        df = df.withColumn(f"m_{k}", F.when(F.size("m_weak") > 0, F.col(f"m_{k}")).otherwise(F.array().cast("array<string>")))
    df = df.select("doc_id", "text", *[spans(F.col("text"), p, F.col(f"m_{k}")).alias(k) for k, p in (KINDS | PARTS).items()])
    strong = F.filter("assign", lambda x: F.length(F.regexp_extract(x["v"], ASSIGN, 2)) >= 12)
    places = lambda c: F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    own = F.filter("weak", lambda x: ~x["v"].rlike(f"{KINDS['access']}|{KINDS['hex']}") & (F.length(F.regexp_extract(x["v"], ASSIGN, 2)) < 12))
    df = df.withColumn("weak", own)
    return df.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), places(strong).alias("assign"), *[places(k).alias(k) for k in ("access", "hex", *PARTS)])


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, row, s, e): weak candidates that have an identifier and an endpoint within scope."""
    whole = scanned.filter((F.size("weak") > 0) & (F.size("identifier") > 0) & (F.size("endpoint") > 0))
    weak = whole.select("doc_id", "row", F.explode("weak").alias("x")).select("doc_id", "row", "x.s", "x.e")
    weak = weak.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("s") - scope) / scope), F.floor((F.col("e") + scope) / scope))))
    for part in ("identifier", "endpoint"):
        there = whole.select(F.col("row").alias("_row"), F.explode(part).alias("x")).select("_row", F.col("x.s").alias("_s"), F.col("x.e").alias("_e"))
        there = there.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_s") / scope), F.floor(F.col("_e") / scope))))
        near = (F.col("_s") - F.col("e") <= scope) & (F.col("s") - F.col("_e") <= scope) & ((F.col("_e") <= F.col("s")) | (F.col("_s") >= F.col("e")))
        held = weak.join(there, (weak["row"] == there["_row"]) & (weak["bucket"] == there["_bucket"]) & near, "left_semi").select("doc_id", "row", "s", "e").distinct()
        weak = held.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("s") - scope) / scope), F.floor((F.col("e") + scope) / scope))))
    return weak.select("doc_id", "row", "s", "e").distinct()


def _ordered(tags: Column, rank: int) -> Column:
    start = lambda x: F.split_part(x, F.lit(":"), F.lit(2)).cast("int")
    return F.transform(tags, lambda x: F.struct(start(x).alias("s"), F.lit(rank).alias("k"), x.alias("x")))


def _in_order(*tags: Column) -> Column:
    """Tagged spans by start, then by kind as listed."""
    return F.array_join(F.transform(F.array_sort(F.concat(*[_ordered(t, i) for i, t in enumerate(tags)])), lambda y: y["x"]), ",")


def secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) for each row of docs."""
    scanned = written(scan(docs, id_col, text), "secret-scan")
    found = link(scanned, scope).groupBy("doc_id", "row").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("linked"))
    found = written(found, "secret-found").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "linked")
    own = scanned.select("doc_id", "row", *KINDS)
    joined = own.join(found, own["doc_id"].eqNullSafe(found["_id"]) & (own["row"] == found["_row"]), "left")
    linked = F.coalesce("linked", F.array().cast("array<struct<s:int,e:int>>"))
    tags = [tagged(k, F.col(k)) for k in KINDS]
    return joined.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_in_order(*tags), 256).alias("base_sha256"),
        _in_order(*tags, tagged("linked", linked)).alias("spans"),
        F.size(linked).cast("long").alias("n_linked"),
    )
