"""Secret scan with multipart credential linking, in DataFrame functions alone.

Exact patterns find the base kinds.  Weaker parts (an identifier, an opaque string, an endpoint) are worth nothing alone:
each is reported only when the parts that complete it to a credential lie within SCOPE code points of it.  That interval
join is an equi-join on cells of SCOPE code points: per document, cell and role only the first and last start are kept, and a
part meets the cells beside its own, so its cost does not depend on how many parts a text holds.

A text is searched once; only texts' parts are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, stage

SCOPE = 200
BLOCK = 512

# The patterns of the base kinds; a match of at least that many characters counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The shortest match is written into these two: what a shorter run would consume holds no other match.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
BASE = ("assign", "access", "hex")

# Weaker parts.
CLIENT = r"""(?i:client_?id|account_?id|access_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{4,}"""
OPAQUE = r"(?<![A-Za-z0-9+/=])(?=[a-z0-9+/]*[A-Z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{32,64}(?![A-Za-z0-9+/=])"
ENDPOINT = r"""(?i:https?|postgres|mysql|mongodb|redis|amqp|jdbc:[a-z]{2,20})://[^\x00-\x20"'<>]{4,}"""
WEAK = ("client", "opaque", "endpoint")
KINDS = BASE + WEAK
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, CLIENT, OPAQUE, ENDPOINT)))
# Each kind's part in a credential, and what must be near a weak one.
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "client": "identifier", "opaque": "secret", "endpoint": "endpoint"}
NEEDS = {"client": ("secret",), "opaque": ("identifier",), "endpoint": ("identifier", "secret")}

SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def running(steps: Column) -> Column:
    """Sum of the steps before each; in blocks, so that growing arrays stay short."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(steps, (b * BLOCK + 1).cast("int"), BLOCK),
    )

    def before(values: Column, start: Column) -> Column:
        zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            values,
            zero,
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )

    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    bases = before(sums, F.lit(0))
    return F.flatten(F.zip_with(blocks, bases, before))


def matches(text: Column, kind: str) -> Column:
    """Spans of a kind's pattern, leftmost and non-overlapping, from the lengths of the matches and of what lies between."""
    pattern = F.lit(PATTERNS[kind])
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
    starts = F.zip_with(running(F.zip_with(gaps, lengths, lambda g, n: g + F.coalesce(n, F.lit(0)))), gaps, lambda b, g: b + g)
    # One gap more than matches: the last start belongs to none.
    value = F.transform(F.regexp_extract_all(text, pattern, F.lit(1)), F.length) if kind == "assign" else lengths
    spans = F.zip_with(
        F.slice(starts, 1, F.size(lengths)),
        F.arrays_zip(lengths.alias("n"), value.alias("v")),
        lambda s, m: F.struct(
            s.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (s + m["n"]).alias("end"), F.lit(kind).alias("kind"), m["v"].alias("v")
        ),
    )
    if kind == "assign":
        spans = F.filter(spans, lambda s: s["v"] >= 8)
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.when(text.rlike(PATTERNS[kind]), spans).otherwise(F.array().cast(SPANS))


def parts(docs: DataFrame) -> DataFrame:
    """``doc_id, key, base, weak``: spans of both sorts of every row; a null text has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", row_key().alias("key"), *[matches(text, k).alias(k) for k in KINDS])
    base = F.array_sort(F.concat(*BASE))
    # A weak part inside a base span is that span.
    weak = F.filter(F.concat(*WEAK), lambda w: ~F.exists(F.concat(*BASE), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return found.select("doc_id", "key", base.alias("base"), weak.alias("weak"))


def linked(found: DataFrame) -> DataFrame:
    """``key, linked``: the weak parts whose complements lie within SCOPE of them, start to start."""
    role = F.element_at(F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair]), F.col("part.kind"))
    every = (
        found.where(F.size("weak") > 0)
        .select("key", F.explode(F.concat("base", "weak")).alias("part"))
        .distinct()
        .select("key", "part", role.alias("role"), F.floor(F.col("part.start") / SCOPE).alias("cell"))
    )
    cells = every.groupBy("key", "cell", "role").agg(F.min("part.start").alias("first"), F.max("part.start").alias("last"))
    # Each cell's interval of starts also meets the cells beside it.
    near = cells.select("key", "role", "first", "last", "cell", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("beside"))
    near = near.select("key", "role", "first", "last", "beside", (F.col("cell") + F.col("beside")).alias("cell"))
    weak = every.where(F.col("part.kind").isin(*WEAK)).select("key", "cell", "part")
    at = F.col("part.start")
    met = weak.join(near, ["key", "cell"]).where(
        (F.col("beside") == 0)
        | ((F.col("beside") == 1) & (at - F.col("last") <= SCOPE))
        | ((F.col("beside") == -1) & (F.col("first") - at <= SCOPE))
    )
    roles = met.groupBy("key", "part").agg(F.collect_set("role").alias("roles"))
    enough = F.lit(False)
    for kind, needs in NEEDS.items():
        here = F.col("part.kind") == kind
        for need in needs:
            here = here & F.array_contains("roles", need)
        enough = enough | here
    return roles.where(enough).groupBy("key").agg(F.collect_list("part").alias("linked"))


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans``: base spans, and all reported ones, by start, then kind as listed; one row per input row.

    Code points, end exclusive.  Null and empty texts have none; rows that repeat repeat; an empty table gives no rows.
    """
    found = stage(parts(docs), "secrets")
    out = found.join(linked(found), "key", "left")
    more = F.coalesce("linked", F.array().cast(SPANS))
    return out.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def shown(own: Column) -> Column:
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, and all spans as text."""
    found = spans(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
