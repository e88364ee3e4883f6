"""Personal data: base patterns, and a bootstrapped contextual extraction in DataFrame operations only.

Base spans seed a graph of patterns and instances. An instance is the value of an identifier-like token: a whole run of
letters, digits and the signs of identifiers with a digit or an at sign in it, a grouped number, or a phone number. Its
lexical patterns are the word before it, the two words before it, the word after it, and both neighbours. None of these
names the value's shape, so an accepted context reaches identifiers of any shape; a fifth pattern, the word before with
the shape (runs of digits as 9, of letters as a), serves where a word alone goes before too much else. Confidence flows both ways, round by round: a pattern's is the mean of
its distinct instances' (with one doubtful instance added), an instance's is one where it is valid as a base kind, else
the noisy-or of its accepted patterns. A pattern with enough distinct known instances and LEAST_CONFIDENCE is accepted
for good; rounds go on until no further pattern is accepted. Tokens that accepted patterns point to are reported as kind
`context` beside the base spans, where they do not overlap one.

The patterns are written so that Java's matcher stays linear on any text: possessive repeats, and look-behinds that skip
starts which cannot match if the earlier one did not. Places are running sums over pieces, so a text's cost grows with
its length alone.

Defined cases: null is empty; empty has no spans; repeated rows each have their own result; rows without an id are kept;
instances and patterns are told apart by 64-bit hashes; columns of other names, whatever they are, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townlens.llm.common import forget, narrow, written
from townlens.llm.spans import digits, luhn, matches, spans, tagged

#: Fixed patterns of the base kinds, in the order of the report.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SIGNS = r"._%+@:/#'-"
_RUN = rf"\p{{L}}\p{{N}}{_SIGNS}"
#: Whole identifiers: phone numbers, numbers in groups, runs of identifier characters with a digit or an at sign.
TOKEN = rf"{KINDS['phone']}|(?<![{_RUN}])[0-9]{{4}}(?:\x20[0-9]{{4,6}}){{2,3}}(?![{_RUN}])|(?<![{_RUN}])(?=[[{_RUN}]&&[^0-9@]]*+[0-9@])[{_RUN}]++"
LAST, LAST_TWO, FIRST = r"(?<!\S)(\S++)\s*+$", r"(?<!\S)(\S++\s++\S++)\s*+$", r"^\s*+(\S++)"
LEAST_INSTANCES, LEAST_CONFIDENCE = 3, 0.8
#: Code points of a bucket of the join that finds tokens over base spans.
BUCKET = 256


def valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.when(F.length(digits(v)).between(16, 19), luhn(digits(v))).otherwise(False)
    if kind == "phone":
        return F.length(digits(v)).between(8, 15)
    return F.lit(True)


def _valid_spans(kind: str) -> Column:
    return F.filter(kind, lambda x: valid(kind, x["v"]))


def known(v: Column) -> Column:
    """Whether a token holds a valid value of a base kind."""
    out = F.lit(False)
    for kind, pattern in KINDS.items():
        inside = F.regexp_extract(v, pattern, 0)
        out = out | ((inside != "") & valid(kind, inside))
    return out


def shape(v: Column) -> Column:
    """Runs of digits become 9, runs of letters a; signs stay."""
    return F.regexp_replace(F.regexp_replace(v, "[0-9]+", "9"), r"\p{L}+", "a")


def _word(text: Column, pattern: str) -> Column:
    """Lower-case words without their signs, null if nothing is left of them."""
    found = F.regexp_replace(F.lower(F.regexp_extract(text, pattern, 1)), r"[^\p{L}\p{N}\s]+", "")
    return F.nullif(F.regexp_replace(F.trim(found), r"\s+", " "), F.lit(""))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over the texts: (doc_id, row, the valid spans of each base kind, tokens with their patterns)."""
    df = narrow(docs, id_col, text)
    patterns = KINDS | {"token": TOKEN}
    df = df.select("doc_id", "text", *[matches(F.col("text"), p).alias(f"m_{k}") for k, p in patterns.items()])
    between = F.when(F.size("m_token") > 0, F.split("text", TOKEN, -1)).otherwise(F.array().cast("array<string>"))
    df = df.select("doc_id", "text", *[spans(F.col("text"), p, F.col(f"m_{k}")).alias(k) for k, p in patterns.items()], between.alias("between"))
    df = df.select("doc_id", "text", *[_valid_spans(k).alias(k) for k in KINDS], F.arrays_zip("token", "between").alias("token"))

    def words(x: Column, i: Column) -> Column:
        """A token without the signs at its ends, and its neighbours; i: its place in the list."""
        v = x["token"]["v"]
        bare = F.ltrim(v, F.lit("._%:/#'-"))
        s = x["token"]["s"] + F.length(v) - F.length(bare)
        bare = F.rtrim(bare, F.lit(_SIGNS))
        after = F.try_element_at("token", i + 2)["between"]
        return F.struct(s.alias("s"), (s + F.length(bare)).alias("e"), bare.alias("v"), _word(x["between"], LAST).alias("l"), _word(x["between"], LAST_TWO).alias("ll"), _word(after, FIRST).alias("r"))

    def described(x: Column) -> Column:
        named = lambda kind, *c: F.when(sum((y.isNull().cast("int") for y in c), F.lit(0)) == 0, F.xxhash64(F.lit(kind), *c))
        sides = F.array(named("l", x["l"]), named("ll", x["ll"]), named("r", x["r"]), named("b", x["l"], x["r"]), named("s", x["l"], shape(x["v"])))
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), F.xxhash64(F.lower(x["v"])).alias("instance"), sides.alias("sides"), known(x["v"]).alias("seed"))

    # the last entry of the zipped list has text after the last token, but no token
    listed = F.filter(F.transform("token", lambda x, i: F.when(x["token"].isNotNull(), words(x, i))), lambda x: x.isNotNull() & x["v"].rlike("[0-9@]"))
    row = F.xxhash64("doc_id", "text").alias("row")
    df = df.select("doc_id", row, *[F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS], listed.alias("token"))
    return df.withColumn("token", F.transform("token", described))


def accept(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(pattern, confidence) of the accepted patterns of a graph (pattern, instance, seed), each edge once; written.
    rounds: stop after so many, though further patterns would be accepted; by default they go on until none is."""
    least = edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_INSTANCES)
    edges = written(edges.join(least, "pattern"), "pii-edges")
    own = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("trust"))
    trust, accepted, done = own, None, 0
    while rounds is None or done < rounds:
        scored = edges.join(trust, "instance").groupBy("pattern").agg(F.sum("trust").alias("sum"), F.max("n").alias("n"), F.sum((F.col("trust") >= LEAST_CONFIDENCE).cast("int")).alias("good"))
        sure = scored.select("pattern", "good", (F.col("sum") / (F.col("n") + 1)).alias("confidence")).filter((F.col("good") >= LEAST_INSTANCES) & (F.col("confidence") >= LEAST_CONFIDENCE)).select("pattern", "confidence")
        fresh = written(sure if accepted is None else sure.join(accepted, "pattern", "left_anti"), "pii-fresh")
        none = fresh.isEmpty()
        if none and accepted is not None:
            forget(fresh)
            break
        old, accepted = accepted, fresh if accepted is None else written(accepted.unionByName(fresh), "pii-patterns")
        if old is not None:
            forget(old)
            forget(fresh)
        if none:
            break
        heard = edges.join(accepted, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("heard"))
        trust = own.join(heard, "instance", "left").select("instance", F.greatest("trust", F.coalesce("heard", F.lit(0.0))).alias("trust"))
        done += 1
    forget(edges)
    return accepted


def _buckets(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("s") / BUCKET), F.floor((F.col("e") - 1) / BUCKET))))


def discover(scanned: DataFrame, rounds: int | None = None) -> DataFrame:
    """(doc_id, row, s, e) of the tokens that accepted patterns point to and no base span overlaps."""
    tokens = scanned.select("doc_id", "row", F.explode("token").alias("t")).select("doc_id", "row", "t.*")
    sided = tokens.select("doc_id", "row", "s", "e", "instance", "seed", F.explode("sides").alias("pattern")).filter("pattern is not null")
    accepted = accept(sided.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), rounds)
    hit = written(sided.join(accepted.select("pattern"), "pattern", "left_semi").select("doc_id", "row", "s", "e").distinct(), "pii-hits")
    base = scanned.join(hit.select("row").distinct(), "row", "left_semi").select("row", F.explode(F.concat(*KINDS)).alias("b")).select(F.col("row").alias("_row"), F.col("b.s").alias("s"), F.col("b.e").alias("e"))
    there = _buckets(base).select("_row", F.col("bucket").alias("_bucket"), F.col("s").alias("_s"), F.col("e").alias("_e"))
    mine = _buckets(hit)
    over = mine.join(there, (mine["row"] == there["_row"]) & (mine["bucket"] == there["_bucket"]) & (mine["s"] < there["_e"]) & (mine["e"] > there["_s"]), "left_semi").select("row", "s", "e").distinct()
    return hit.join(over, ["row", "s", "e"], "left_anti").select("doc_id", "row", "s", "e")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context) for each row of docs."""
    scanned = written(scan(docs, id_col, text), "pii-scan")
    found = discover(scanned, rounds).groupBy("doc_id", "row").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("context"))
    found = written(found, "pii-found").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "context")
    own = scanned.drop("token")
    joined = own.join(found, own["doc_id"].eqNullSafe(found["_id"]) & (own["row"] == found["_row"]), "left")
    base = F.concat(*[tagged(k, F.col(k)) for k in KINDS])
    context = F.coalesce("context", F.array().cast("array<struct<s:int,e:int>>"))
    return joined.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, tagged("context", context)), ",").alias("spans"),
        F.size(context).cast("long").alias("n_context"),
    )
