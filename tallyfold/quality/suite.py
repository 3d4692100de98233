"""Running rules over a table.

Decisions: value rules ignore nulls, and NaN counts as null in row rules; a rule
succeeds when it has no offending value; a rule whose column is missing fails
and the run goes on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import lenient_double, moment
from ..operators.enrich import orphan_keys
from ..operators.skew import KeyTable, flagged_keys, lookup_left_join
from ..schemas import TYPE_NAMES
from .rules import KEY_KINDS, ROW_KINDS, SCHEMA_KINDS, Rule

MISSING_COLUMN = "column is missing"


def _value(rule: Rule, df: DataFrame) -> Column:
    value = F.col(f"`{rule.column}`")
    if isinstance(df.schema[rule.column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def _offends(rule: Rule, df: DataFrame, as_of: Column) -> Column:
    """True, false or null; null means the value is not judged."""
    value, dtype = _value(rule, df), df.schema[rule.column].dataType
    if rule.kind == "not_null":
        return value.isNull()
    if rule.kind == "matches_regex":
        # The expression has to match from the first character on, as in a match rather than a search.
        return ~value.cast("string").rlike(f"^(?:{rule.pattern})")
    if rule.kind == "in_set":
        return ~value.isin(list(rule.values))
    if rule.kind == "less_than":
        return value >= (as_of.cast(dtype) if rule.limit == "now" else F.lit(rule.limit))
    if not isinstance(dtype, T.StringType):
        return ~value.between(rule.low, rule.high)
    # Text in a numeric range: what is not a number is outside.
    return value.isNotNull() & ~F.coalesce(lenient_double(value).between(rule.low, rule.high), F.lit(False))


def _schema_ok(rule: Rule, df: DataFrame) -> bool:
    if rule.kind == "column_exists":
        return True
    actual = df.schema[rule.column].dataType.simpleString()
    return actual == TYPE_NAMES.get(rule.type_name, rule.type_name)


def _now(as_of: datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else moment(as_of)


def _usable(rule: Rule, df: DataFrame) -> bool:
    return rule.column in df.columns


def _counted_in_one_pass(df: DataFrame, rules: Sequence[tuple[int, Rule]], as_of: Column, by: Sequence[str]) -> DataFrame:
    """All row rules as counters of a single aggregate, then one row per rule."""
    counters, entries = [], []
    for no, rule in rules:
        if not _usable(rule, df):
            evaluated, unexpected = F.lit(0), F.lit(0)
        elif rule.kind in SCHEMA_KINDS:
            evaluated, unexpected = F.lit(1), F.lit(0 if _schema_ok(rule, df) else 1)
        else:
            judged = F.lit(1) if rule.kind == "not_null" else _value(rule, df)
            counters += [F.count(judged).alias(f"_e{no}"), F.count_if(_offends(rule, df, as_of)).alias(f"_u{no}")]
            evaluated, unexpected = F.col(f"_e{no}"), F.col(f"_u{no}")
        entries.append(F.struct(F.lit(no).alias("rule_no"), evaluated.cast("bigint").alias("evaluated"),
                                unexpected.cast("bigint").alias("unexpected")))
    counted = df.groupBy(*by).agg(*counters, F.count(F.lit(1)).alias("_rows"))
    return counted.select(*by, F.inline(F.array(*entries)))


def _unique_count(df: DataFrame, rule: Rule, no: int, by: Sequence[str]) -> DataFrame:
    """Rows per key first, so a frequent key is one counter and not a group of rows."""
    per_key = (df.where(F.col(f"`{rule.column}`").isNotNull()).groupBy(*by, F.col(f"`{rule.column}`").alias("_key"))
               .agg(F.count("*").alias("n")))
    n = F.col("n")
    return _key_rule_row(per_key, no, F.sum(n), F.sum(F.when(n > 1, n)), by)


def _reference_count(df: DataFrame, rule: Rule, no: int, reference: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = reference.select(F.col(rule.reference_column).alias("_key")).where("_key is not null").distinct()
    per_key = (df.where(F.col(f"`{rule.column}`").isNotNull()).groupBy(*by, F.col(f"`{rule.column}`").alias("_key"))
               .agg(F.count("*").alias("n")))
    matched = per_key.join(keys.withColumn("_known", F.lit(True)), "_key", "left")
    return _key_rule_row(matched, no, F.sum("n"), F.sum(F.when(F.col("_known").isNull(), F.col("n"))), by)


def _key_rule_row(per_key: DataFrame, no: int, evaluated: Column, unexpected: Column, by: Sequence[str]) -> DataFrame:
    return (per_key.groupBy(*by).agg(F.coalesce(evaluated, F.lit(0)).alias("evaluated"),
                                     F.coalesce(unexpected, F.lit(0)).alias("unexpected"))
            .select(*by, F.lit(no).alias("rule_no"), "evaluated", "unexpected"))


def run_suite(df: DataFrame, suite: str, rules: Sequence[Rule], *, references: Mapping[str, DataFrame] | None = None,
              as_of: datetime | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per rule (and per group of ``by``).

    The table is scanned once for all row rules together; each uniqueness or
    reference rule adds one scan of its key column.
    """
    numbered = list(enumerate(rules, start=1))
    single_pass = [(no, r) for no, r in numbered if r.kind not in KEY_KINDS or not _usable(r, df)]
    parts = [_counted_in_one_pass(df, single_pass, _now(as_of), by)] if single_pass else []
    for no, rule in numbered:
        if rule.kind == "unique" and _usable(rule, df):
            parts.append(_unique_count(df, rule, no, by))
        elif rule.kind == "exists_in" and _usable(rule, df):
            parts.append(_reference_count(df, rule, no, (references or {})[rule.reference_table], by))

    def per_rule(pick) -> Column:
        return F.element_at(F.array(*[F.lit(pick(r)) for r in rules]), F.col("rule_no"))

    present = per_rule(lambda r: _usable(r, df))
    share = F.when(F.col("evaluated") > 0, 100 * F.col("unexpected") / F.col("evaluated")).otherwise(F.lit(0.0))
    return reduce(DataFrame.unionByName, parts).select(
        *by, F.lit(suite).alias("suite"), "rule_no",
        per_rule(lambda r: r.name).alias("rule"), per_rule(lambda r: r.column).alias("column"),
        per_rule(lambda r: r.severity).alias("severity"),
        "evaluated", "unexpected", share.alias("unexpected_percent"),
        (present & (F.col("unexpected") == 0)).alias("success"),
        F.when(~present, F.lit(MISSING_COLUMN)).otherwise(per_rule(lambda r: r.message)).alias("message"),
    )


def _names_of(failed: Sequence[tuple[str, Column]]) -> Column:
    names = [F.when(c, F.lit(name)) for name, c in failed]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def _row_failures(df: DataFrame, rules: Sequence[Rule], as_of: Column) -> list[tuple[str, Column]]:
    """A column that is missing, or has the wrong type, fails every row."""
    failed = []
    for rule in rules:
        if rule.kind in SCHEMA_KINDS or not _usable(rule, df):
            failed.append((rule.name, F.lit(not (_usable(rule, df) and _schema_ok(rule, df)))))
        elif rule.kind in ROW_KINDS:
            failed.append((rule.name, F.coalesce(_offends(rule, df, as_of), F.lit(False))))
    return failed


def with_failed_rules(df: DataFrame, rules: Sequence[Rule], *, as_of: datetime | None = None) -> DataFrame:
    """Rows with the names of the rules they fail, on a table or a stream. Key rules need all rows at once and are refused."""
    if keyed := [r.name for r in rules if r.kind in KEY_KINDS]:
        raise ValueError(f"no rules of single rows: {keyed}")
    return df.withColumn("failed_rules", _names_of(_row_failures(df, rules, _now(as_of))))


def _marked(df: DataFrame, rules: Sequence[Rule], references: Mapping[str, DataFrame] | None,
            as_of: datetime | None) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """The rows with what is needed to judge them, and a condition per rule that says who fails it."""
    marked, failed = df, dict(_row_failures(df, rules, _now(as_of)))
    for no, rule in enumerate(rules):
        if rule.kind not in KEY_KINDS or not _usable(rule, df):
            continue
        if rule.kind == "unique":
            bad = _duplicates(df, rule.column)
        else:
            bad = orphan_keys(df, rule.column, (references or {})[rule.reference_table], rule.reference_column)
        mark = f"_bad{no}"
        marked = lookup_left_join(marked, bad).withColumnRenamed("occurrences", mark)
        failed[rule.name] = F.col(mark).isNotNull()
    return marked, [(r.name, failed[r.name]) for r in rules]


def split_valid(df: DataFrame, rules: Sequence[Rule], *, severity: str = "critical",
                references: Mapping[str, DataFrame] | None = None,
                as_of: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule of ``severity``, key rules included, and the others with ``failed_rules``."""
    marked, failed = _marked(df, [r for r in rules if r.severity == severity], references, as_of)
    marked = marked.select(*df.columns, _names_of(failed).alias("failed_rules"))
    return marked.where(F.size("failed_rules") == 0).drop("failed_rules"), marked.where(F.size("failed_rules") > 0)


def offending_rows(df: DataFrame, rules: Sequence[Rule], *, references: Mapping[str, DataFrame] | None = None,
                   as_of: datetime | None = None) -> DataFrame:
    """Rows failing any rule, with the names of those rules in ``failed_rules``."""
    marked, failed = _marked(df, rules, references, as_of)
    hit = reduce(or_, [c for _, c in failed])
    return marked.where(hit).select(*df.columns, _names_of(failed).alias("failed_rules"))


def _duplicates(df: DataFrame, key: str, **sizes: int | None) -> KeyTable:
    return flagged_keys(df, key, lambda counts: counts.withColumn("_flag", F.col("occurrences") > 1), **sizes)


def rows_with_duplicate_key(df: DataFrame, key: str, *, min_rows: int | None = None,
                            broadcast_rows: int | None = None) -> DataFrame:
    """Every row whose non-null key occurs more than once, with ``occurrences``."""
    joined = lookup_left_join(df, _duplicates(df, key, min_rows=min_rows, broadcast_rows=broadcast_rows))
    return joined.where("occurrences is not null").select(*df.columns, "occurrences")
