"""Line dedup: winnowing over line hashes (DataFrame functions only).

The lines of a text that are not blank become hashes, every ``GRAM`` neighbours
a gram.  A line of ``LONG_WORDS`` words or more is a gram by itself and always a
fingerprint.  From each window of ``WINDOW`` grams the smallest (rightmost if equal)
is a fingerprint, so every repeated run of GRAM + WINDOW - 1 lines has one in
both places.  Around a fingerprint that occurs again, the lines of its gram and of the
gram with its neighbours on either side, as far as the next fingerprint must lie,
are runs; each run's later places are joined with its first one in the order of
(doc_id, line), and their lines are deleted.  So a run is compared with the
earliest place that has its own neighbour, whatever stands around the gram
elsewhere, and every repeated run of GRAM + WINDOW - 1 lines goes whole; so does every one of one
or two lines that come to 2 * LONG_WORDS words, as one of them is long.
The first place of any line is never deleted.

Every fingerprint row carries the line hashes around it, so the runs need no
lookup, and one that many documents share costs partial aggregates and joins
without any order inside the key.

Defined results: a null or empty text, or one with a single line that is not long, is
left as it is; rows with the same id and text are one document and get the same result; an
empty table gives no rows; lines of white space alone are blank and stay; lines are the same if they
differ in white space at their ends only (so CRLF texts match LF texts); other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import KEY, saved, text_key
from kpiloom.llm.similar import small_side

GRAM, WINDOW = 2, 2
BLANK = " \t\r\f\v"         # lines are compared without these at their ends
LONG_WORDS = 25
_LONG = r"^\s*+(?:\S++\s++){%d}\S" % (LONG_WORDS - 1)
REMOVED = "__kpl_removed"    # column of removed line places


def line_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text key, number, hashes and places of its lines that are not blank, and which are long."""
    rows = docs.select("doc_id", *text_key(F.col("text")), F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    solid = F.filter(F.transform("lines", lambda x, i: F.struct(F.btrim(x, F.lit(BLANK)).alias("x"), i.alias("i"))), lambda s: s["x"] != "")
    rows = rows.select("doc_id", *KEY, solid.alias("solid"))
    rows = rows.select("doc_id", *KEY, F.transform("solid", lambda s: F.xxhash64(s["x"])).alias("hashes"),
                       F.col("solid.i").alias("places"), F.transform("solid", lambda s: s["x"].rlike(_LONG)).alias("long"))
    one = rows.groupBy("doc_id", *KEY).agg(*[F.first(c).alias(c) for c in ("hashes", "places", "long")])
    return saved(one.withColumn("number", F.monotonically_increasing_id()))


def fingerprints(lines: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, number, pos, size, print, around): window minima and long lines; ``pos`` counts solid lines from 0."""
    margin = window - 1
    n = F.size("hashes")
    last = F.greatest(n - gram, F.lit(0))
    grams = F.transform(F.sequence(F.lit(0), last),
                        lambda i: F.struct(F.xxhash64(*[F.get("hashes", i + k) for k in range(gram)]).alias("print"),
                                           (-i).alias("back")))
    grams = F.when(n >= gram, grams).otherwise(F.array().cast("array<struct<print: long, back: int>>"))
    rows = lines.where(n > 0).select("doc_id", "number", "hashes", "long", grams.alias("grams"))
    m = F.size("grams")
    chosen = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(m - window + 1, F.lit(1))),
                                          lambda i: F.array_min(F.slice("grams", i, window))))
    chosen = F.transform(F.filter(chosen, lambda g: g.isNotNull()),
                         lambda g: F.struct(g["print"].alias("print"), (-g["back"]).alias("pos"), F.lit(gram).alias("size")))
    alone = F.transform("hashes", lambda h, i: F.struct(F.xxhash64(h).alias("print"), i.alias("pos"), F.lit(1).alias("size")))
    alone = F.filter(alone, lambda g: F.get("long", g["pos"]))
    rows = rows.select("doc_id", "number", "hashes", F.explode(F.concat(chosen, alone)).alias("g"))
    rows = rows.select("doc_id", "number", "hashes", "g.pos", "g.size", "g.print")
    around = F.transform(F.sequence(F.lit(-margin), F.col("size") - 1 + margin),
                         lambda k: F.when(F.col("pos") + k >= 0, F.get("hashes", F.col("pos") + k)))
    return rows.select("doc_id", "number", "pos", "size", "print", around.alias("around"))


def repeated_runs(prints: DataFrame, window: int = WINDOW) -> DataFrame:
    """(number, low, high, first_doc_id): solid lines low..high that repeat an earlier run."""
    margin = window - 1
    often = (prints.groupBy(F.col("print").alias("f_print")).agg(F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select("f_print"))
    met = saved(prints.join(often, F.col("print") == F.col("f_print")).drop("f_print", "print"))

    def run(left: int, right: int) -> Column:
        return F.struct((F.col("pos") - left).alias("low"), F.slice("around", F.lit(margin + 1 - left), F.col("size") + (left + right)).alias("lines"))

    runs = F.array(*[run(k, 0) for k in range(margin + 1)], *[run(0, k) for k in range(1, margin + 1)])
    runs = F.filter(runs, lambda r: ~F.exists(r["lines"], lambda x: x.isNull()))          # inside the text
    places = met.select("doc_id", "number", F.explode(runs).alias("r")).select("doc_id", "number", "r.low", "r.lines")
    first = (places.groupBy(F.col("lines").alias("f_lines"))          # lines decide, a gram's hash may collide
                   .agg(F.min(F.struct("doc_id", "number", "low")).alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select("f_lines", "first"))
    later = places.join(small_side(saved(first)), F.col("lines") == F.col("f_lines"))
    later = later.where(~((F.col("number") == F.col("first.number")) & (F.col("low") == F.col("first.low"))))
    return later.select("number", "low", (F.col("low") + F.size("lines") - 1).alias("high"), F.col("first.doc_id").alias("first_doc_id"))


def removed_lines(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, text key, removed): sorted line places (from 0) that go, for documents that lose any."""
    lines = line_table(docs)
    runs = repeated_runs(fingerprints(lines, gram, window), window)
    gone = (runs.select("number", F.explode(F.sequence("low", "high")).alias("at"))
                .groupBy(F.col("number").alias("d_number")).agg(F.collect_set("at").alias("gone")))
    return (lines.join(gone, F.col("number") == F.col("d_number"))
                 .select("doc_id", *KEY, F.array_sort(F.transform("gone", lambda i: F.get("places", i))).alias("removed")))


def dedup_lines(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """All rows and columns with the text less its repeated runs, and the column ``REMOVED`` (line places, empty if none)."""
    gone = removed_lines(docs, gram, window)
    keys = ["doc_id", *KEY]
    gone = gone.select(*[F.col(k).alias(f"__kpl_g_{k}") for k in keys], F.col("removed").alias(REMOVED))
    rows = docs.select("*", *[c.alias(f"__kpl_k{i}") for i, c in enumerate(text_key(docs["text"]))])
    cond = rows["doc_id"].eqNullSafe(F.col("__kpl_g_doc_id"))
    for i, k in enumerate(KEY):
        cond = cond & (F.col(f"__kpl_k{i}") == F.col(f"__kpl_g_{k}"))
    met = rows.join(gone, cond, "left")
    # removed places as a set of flags: one pass over the lines, whatever their number
    flags = F.map_from_arrays(F.col(REMOVED), F.transform(REMOVED, lambda _: F.lit(True)))
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: F.element_at(F.col("__kpl_flags"), i).isNull()), "\n")
    met = met.withColumn("__kpl_flags", F.when(F.col(REMOVED).isNotNull(), flags))
    text = F.when(F.col(REMOVED).isNull(), F.col("text")).otherwise(rest)
    return met.select(*[text.alias("text") if c == "text" else met[c] for c in docs.columns],
                      F.coalesce(REMOVED, F.array().cast("array<int>")).alias(REMOVED))
