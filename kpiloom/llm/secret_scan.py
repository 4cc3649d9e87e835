"""Secret scans: base patterns and multipart credential linking (DataFrame functions only).

Base spans come from three patterns (assignments, access keys, hexadecimal
runs).  Further parts are weak: identifiers, opaque keys and endpoints.  A weak
part is reported only where an interval join finds a complementary part within
its scope: a secret beside an identifier or an endpoint, or the reverse.  The
join is an equality on (text, bin) with a distance condition; a bin is as wide
as the scope, so a part meets only the few that fit into the bins around it.  A weak
part that overlaps a base span is none.

Spans are code points, end exclusive.  Defined results: a null text is empty;
rows with the same id and text give the same result; an empty table gives no
rows; very long texts are scanned whole; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import KEY, saved, text_key

# Base patterns in their order, the group that has a least length, and that length.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),          # runs, so those of 24 or more are all that pass
)
# Weak parts and their role.
WEAK = (
    ("id", r"""(?i:(?:access_?key_?id|client_?id|account_?id|user_?name|login))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", "identifier"),
    ("key", r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Za-z])[A-Za-z0-9+/]{32,88}={0,2}(?![A-Za-z0-9+/=_-])", "secret"),
    ("endpoint", r"""(?i:https?|jdbc:[a-z0-9]+|postgres|mysql|redis|mongodb|amqp|s3)://[^\x20\x09-\x0D"'<>]+""", "endpoint"),
)
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", **{k: r for k, _, r in WEAK}}
SCOPE = 200             # code points between two parts of a credential, at most
_SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _placed(parts: Column) -> Column:
    """(start, end, test) of matches given as (gap before, len, test).

    A fold that appends copies its array at every step, so the matches are
    placed in blocks of about sqrt(n), then the blocks: n * sqrt(n) steps in all.
    """
    none = F.array().cast("array<struct<start:int,end:int,test:int>>")

    def block(part: Column) -> Column:
        return F.aggregate(part, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["len"]).alias("end"),
                                                  x["test"].alias("test")))).alias("out")))

    def blocks(p: Column) -> Column:
        def cut(width: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(p) - 1, F.lit(0)) / width).cast("int")),
                               lambda i: block(F.slice(p, i * width + 1, width)))
        return _let(F.greatest(F.ceil(F.sqrt(F.size(p))).cast("int"), F.lit(1)), cut)

    def shifted(done: Column) -> Column:
        heads = F.aggregate(done, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, x: F.struct(
            (acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(done, heads, lambda x, head: F.transform(x["out"], lambda s: F.struct(
            (s["start"] + head).alias("start"), (s["end"] + head).alias("end"), s["test"].alias("test")))))

    return _let(_let(parts, blocks), shifted)


def spans(text: Column, kind: str, pattern: str, order: int, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, ord, end, kind); failing ones are dropped afterwards."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = (F.arrays_zip(found.alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("t")) if group
             else F.transform(found, lambda m: F.struct(m.alias("m"), m.alias("t"))))
    lengths = F.zip_with(F.split(text, pattern, -1), pairs,
                         lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["m"]).alias("len"),
                                                 F.length(m["t"]).alias("test")))
    placed = _placed(F.filter(lengths, lambda x: x["len"].isNotNull()))
    good = F.transform(F.filter(placed, lambda s: s["test"] >= least),
                       lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("ord"), s["end"].alias("end"),
                                          F.lit(kind).alias("kind")))
    return F.when(text.rlike(pattern), good).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def joined(spans_: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans_), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _bins(start: Column, end: Column, margin: int) -> Column:
    low = F.floor((start - margin) / SCOPE)
    return F.explode(F.sequence(low, F.greatest(low, F.floor((end + margin) / SCOPE))))


def _same(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"o_{k}"))
    return cond


def link_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The weak parts (keys, span) that lie clear of base spans and have a complementary part within the scope."""
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    each = parts.distinct().withColumn("role", role[F.col("span.kind")])
    is_weak = F.col("span.kind").isin([k for k, _, _ in WEAK])
    other = (each.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("span.start").alias("o_start"), F.col("span.end").alias("o_end"),
                         F.col("role").alias("o_role"), is_weak.alias("o_weak"))
                 .withColumn("o_bin", _bins(F.col("o_start"), F.col("o_end"), 0)))
    meets = (F.col("bin") == F.col("o_bin")) & _same(keys)
    covered = meets & ~F.col("o_weak") & (F.col("o_start") < F.col("span.end")) & (F.col("span.start") < F.col("o_end"))
    hit = (each.where(is_weak).withColumn("bin", _bins(F.col("span.start"), F.col("span.end"), 0))
               .join(other, covered, "left_semi").select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("span").alias("o_span")).distinct())
    clear = saved(each.join(hit, _same(keys) & (F.col("span") == F.col("o_span")), "left_anti"))
    weak = clear.where(is_weak).withColumn("bin", _bins(F.col("span.start"), F.col("span.end"), SCOPE))
    other = (clear.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("span.start").alias("o_start"), F.col("span.end").alias("o_end"),
                          F.col("role").alias("o_role"))
                  .withColumn("o_bin", _bins(F.col("o_start"), F.col("o_end"), 0)))
    near = F.greatest(F.col("span.start"), F.col("o_start")) - F.least(F.col("span.end"), F.col("o_end")) <= SCOPE
    pair = (F.col("role") != F.col("o_role")) & ((F.col("role") == "secret") | (F.col("o_role") == "secret"))
    return weak.join(other, meets & near & pair, "left_semi").select(*keys, "span").distinct()


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, linked) of every row: arrays of spans (start, ord, end, kind)."""
    keys = ["doc_id", *KEY]
    text = F.col("_text")
    rows = docs.select("doc_id", *text_key(F.col("text")), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    base = F.concat(*[spans(text, k, p, i, g, n) for i, (k, p, g, n) in enumerate(BASE)])
    weak = F.concat(*[spans(text, k, p, len(BASE) + i) for i, (k, p, _) in enumerate(WEAK)])
    scan = saved(rows.select(*keys, F.array_sort(base).alias("base"), weak.alias("weak")))
    parts = (scan.where(F.size("weak") > 0)
                 .select(*keys, F.explode(F.concat("base", "weak")).alias("span")))
    linked = (link_parts(parts, keys).groupBy(*keys).agg(F.array_sort(F.collect_list("span")).alias("linked")))
    linked = linked.select(*[F.col(k).alias(f"o_{k}") for k in keys], "linked")
    return (scan.join(linked, _same(keys), "left")
                .select("doc_id", "base", F.coalesce("linked", F.array().cast(_SPAN)).alias("linked")))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the base spans' SHA-256 and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k, *_ in BASE], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "linked")).alias("spans"))
