"""Data-quality checks: each returns the *failing rows* as a DataFrame.

Row semantics follow the generic tests the reference declares in YAML:

* not_null        -> rows where the column is null
* unique          -> one row per duplicated non-null value (value, n_records)
* relationships   -> child rows (non-null key) without a parent row
* accepted_values -> one row per distinct offending value; null is not a failure
* accepted_range  -> rows outside [min, max]; null passes

Counting without the rows themselves:

* ``batched_failures`` counts the row-level checks of a table in one scan;
* ``observe_failures`` counts them while the table is being written, by metrics
  observed on its rows, so no scan of their own is needed;
* ``relationship_counts`` reduces the child to (check, key) with counts and looks
  the keys up in the parents' key sets, kept as exact bitmaps of 32,768 keys;
* ``unique_candidates`` finds the hashes that occur more than once; only their rows
  are grouped by the key itself.  Keys of whole numbers and dates are hashed as they
  are, without the text that joins them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def concat_key(*cols: str) -> Column:
    """``a || '-' || b ...``: null if any part is null (like SQL ``||``)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.col(c).cast("string"))
    return F.concat(*parts)


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, key: Column | str) -> DataFrame:
    """Duplicated values; partial aggregation keeps a hot value cheap."""
    k = F.col(key) if isinstance(key, str) else key
    return (df.select(k.alias("unique_field")).filter(F.col("unique_field").isNotNull())
            .groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def relationship_failures(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent (left anti join).

    Nothing is broadcast by hand: AQE broadcasts the parent when its runtime
    size is under the threshold and otherwise splits skewed child partitions.
    """
    keys = parent.select(F.col(field).alias("__parent_key"))
    kids = child.filter(F.col(column).isNotNull())
    return kids.join(keys, kids[column] == keys["__parent_key"], "left_anti")


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct offending values with their row counts."""
    return (df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(~F.col("value_field").isin(list(values))))


def range_condition(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c = F.col(column)
    cond = F.lit(True)
    if min_value is not None:
        cond = cond & ((c >= F.lit(min_value)) if inclusive else (c > F.lit(min_value)))
    if max_value is not None:
        cond = cond & ((c <= F.lit(max_value)) if inclusive else (c < F.lit(max_value)))
    return cond


def accepted_range_failures(df: DataFrame, column: str, min_value=None, max_value=None,
                            inclusive: bool = True) -> DataFrame:
    """Rows where NOT(condition) is true; a null makes it null, so null passes."""
    return df.filter(~range_condition(column, min_value, max_value, inclusive))


def _as_rows(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of counts c0, c1, ... as rows (name, failures)."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("failures"))
        for i, name in enumerate(names)]))
    return counts.select(rows.alias("r")).select("r.name", "r.failures")


def _offending(column: str, values: Sequence) -> Column:
    return F.when(~F.col(column).isin(list(values)), F.col(column))


def batched_failures(df: DataFrame, row_checks: Sequence[tuple[str, Column]] = (),
                     value_checks: Sequence[tuple[str, str, Sequence]] = ()) -> DataFrame:
    """Failure counts of many checks of one table in a single scan and aggregate.

    * ``row_checks``: (name, failing-row predicate) -> failing rows
      (not_null, accepted_range);
    * ``value_checks``: (name, column, accepted values) -> number of distinct
      offending values (accepted_values; null is never offending).

    Returns (name, failures).
    """
    aggs = [F.count_if(F.coalesce(pred, F.lit(False))) for _, pred in row_checks]
    aggs += [F.count_distinct(_offending(column, values)) for _, column, values in value_checks]
    names = [name for name, *_ in (*row_checks, *value_checks)]
    return _as_rows(df.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)]), names)


def observe_failures(df: DataFrame, row_checks: Sequence[tuple[str, Column]] = (),
                     value_checks: Sequence[tuple[str, str, Sequence]] = ()
                     ) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with metrics on its rows, and what gives the failures by check once an action has written it.

    Metrics can't count distinct values, so of the offending values their rows,
    the least and the greatest are observed: none means 0 failures, one value
    means 1.  A check with several offending values is left out of the result and
    has to be counted by a scan.
    """
    if not row_checks and not value_checks:
        return df, dict
    seen = Observation()
    metrics = [F.count_if(F.coalesce(pred, F.lit(False))).alias(f"r{i}") for i, (_, pred) in enumerate(row_checks)]
    for i, (_, column, values) in enumerate(value_checks):
        bad = _offending(column, values)
        metrics += [F.count(bad).alias(f"n{i}"), F.min(bad).alias(f"lo{i}"), F.max(bad).alias(f"hi{i}")]

    def failures() -> dict[str, int]:
        got = seen.get
        out = {name: got[f"r{i}"] for i, (name, _) in enumerate(row_checks)}
        for i, (name, *_) in enumerate(value_checks):
            if not got[f"n{i}"] or got[f"lo{i}"] == got[f"hi{i}"]:
                out[name] = min(1, got[f"n{i}"])
        return out
    return df.observe(seen, *metrics), failures


def _bit_key(df: DataFrame, column: str) -> Column | None:
    """The column as a whole number that keys a bitmap; None for other types."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("long")
    return F.col(column).cast("long") if isinstance(kind, T.IntegralType) else None


def key_bitmaps(df: DataFrame, column: str) -> DataFrame:
    """(bucket, bits): the exact set of a column's whole numbers or dates, 32,768 to a bitmap; combined map-side."""
    keys = df.select(_bit_key(df, column).alias("key")).filter(F.col("key").isNotNull())
    return (keys.groupBy(F.bitmap_bucket_number("key").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")))


def _absent(key: str) -> Column:
    """Whether a key is not in the bitmap of its bucket (``bits``, null without one)."""
    return F.expr(f"""coalesce(shiftright(cast(conv(hex(substring(bits, cast(bitmap_bit_position({key}) div 8 as int) + 1, 1)), 16, 10) as int),
                                         cast(bitmap_bit_position({key}) % 8 as int)) & 1, 0) = 0""")


def relationship_counts(child: DataFrame, checks: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """(name, failures): child rows with a non-null key that the parent lacks, for checks (name, column, parent, field).

    The child's rows are not shuffled: they are reduced map-side to (check, key)
    with a count, all checks in one scan.  Whole-number and date keys are looked up
    in the parents' bitmaps, joined by (check, bucket); keys of other types in the
    parents' distinct keys.
    """
    coded = [c for c in checks if _bit_key(child, c[1]) is not None and _bit_key(c[2], c[3]) is not None]
    parts = []
    for some, bits in ((coded, True), ([c for c in checks if c not in coded], False)):
        if not some:
            continue
        pairs = F.array(*[F.struct(F.lit(i).alias("check"), (_bit_key(child, column) if bits else F.col(column).cast("string")).alias("key"))
                          for i, (_, column, _, _) in enumerate(some)])
        keys = (child.select(F.explode(pairs).alias("pair")).select("pair.*").filter(F.col("key").isNotNull())
                .groupBy("check", "key").agg(F.count(F.lit(1)).alias("rows")))
        known = None
        for i, (_, _, parent, field) in enumerate(some):
            own = key_bitmaps(parent, field) if bits else parent.select(
                F.col(field).cast("string").alias("key")).distinct().withColumn("found", F.lit(True))
            own = own.withColumn("check", F.lit(i))
            known = own if known is None else known.unionByName(own)
        if bits:
            found = keys.withColumn("bucket", F.bitmap_bucket_number("key")).join(known, ["check", "bucket"], "left")
            missing = _absent("key")
        else:
            found, missing = keys.join(known, ["check", "key"], "left"), F.col("found").isNull()
        counts = found.agg(*[F.sum(F.when((F.col("check") == i) & missing, F.col("rows"))).alias(f"c{i}") for i in range(len(some))])
        parts.append(_as_rows(counts, [name for name, *_ in some]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _hashed_keys(df: DataFrame, key: Column | Sequence[str]) -> DataFrame:
    """(key, hash) of the rows with a key: an expression, or the columns of a ``concat_key``.

    Joined texts of whole numbers and dates are equal only if all parts are, so those parts are hashed themselves.
    """
    if isinstance(key, Column):
        text, parts = key, ()
    else:
        text = concat_key(*key)
        plain = all(isinstance(df.schema[c].dataType, (T.IntegralType, T.DateType)) for c in key)
        parts = tuple(key) if plain else ()
    if not parts:
        return df.select(text.alias("key")).filter(F.col("key").isNotNull()).withColumn("hash", F.xxhash64("key"))
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in parts])).select(
        text.alias("key"), F.xxhash64(*parts).alias("hash"))


def unique_candidates(checks: Sequence[tuple[str, DataFrame, Column | Sequence[str]]]) -> DataFrame:
    """(name, hash) of the 64-bit key hashes that more than one row of a table has, for checks (name, table, key).

    Hashes are shuffled, not keys: a table without repeats has no candidates and
    is done; otherwise ``repeated_keys`` groups the candidates' rows exactly.
    """
    hashes = None
    for i, (_, df, key) in enumerate(checks):
        own = _hashed_keys(df, key).select(F.lit(i).alias("check"), "hash")
        hashes = own if hashes is None else hashes.unionByName(own)
    repeated = hashes.groupBy("check", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return repeated.select(F.array(*[F.lit(name) for name, *_ in checks])[F.col("check")].alias("name"), "hash")


def repeated_keys(df: DataFrame, key: Column | Sequence[str], hashes: DataFrame) -> DataFrame:
    """``unique_failures`` of the rows whose key hash is among ``hashes``."""
    return unique_failures(_hashed_keys(df, key).join(hashes.select("hash"), "hash", "left_semi"), "key")


def _not_in(keys: DataFrame, column: str, other: DataFrame) -> DataFrame:
    """Distinct values of a whole-number column (null included) that the other table's column lacks."""
    each = keys.select(column).distinct().withColumn("bucket", F.bitmap_bucket_number(column))
    return each.join(key_bitmaps(other, column), "bucket", "left").filter(_absent(column)).select(column)


def orphan_plans_in_claims(claims: DataFrame, pmg: DataFrame) -> DataFrame:
    """Distinct claim plan ids missing from the reference table (nulls included)."""
    return _not_in(claims, "plan_id", pmg)


def orphan_plans_in_dimension(pmg: DataFrame, claims: DataFrame) -> DataFrame:
    """Distinct reference-table plan ids never seen in claims."""
    return _not_in(pmg, "plan_id", claims)
