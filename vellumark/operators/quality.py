"""Data-quality profile of any flat table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_half_up

NUMERIC_TYPES = ("int", "bigint", "double", "float")
WHOLE_TYPES = ("int", "bigint")
NULL_PCT_ALERT = 5.0
# Shorter than a digest, so a digest never equals a value that is kept.
LONG_VALUE = 64


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(round_half_up(part / F.nullif(whole, F.lit(0)) * 100, 2), F.lit(0.0))


def _cell_key(value: Column) -> Column:
    """A long value by its digest, so that no long text is shuffled."""
    return F.when(F.length(F.trim(value)) > LONG_VALUE, F.concat(F.lit("#"), F.sha2(value, 256))).otherwise(value)


def _text(name: str, kind: str) -> Column:
    """A value as text: numbers without a negative zero, nested values as JSON, which keeps their parts apart."""
    value = F.col(name)
    if kind in NUMERIC_TYPES:
        # Adding zero turns -0.0 into 0.0, which are one value.
        return (value + F.lit(0).cast(kind)).cast("string")
    if kind.startswith(("array", "struct", "map")):
        return F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return value.cast("string")


def _cells(df: DataFrame, key: list[str] | None) -> DataFrame:
    """(at, value, number, whole): one row per cell; the key columns together are the cell at -1."""
    cells = []
    for i, (name, kind) in enumerate(df.dtypes):
        cells.append(
            F.struct(
                F.lit(i).alias("at"),
                _cell_key(_text(name, kind)).alias("value"),
                (F.col(name) if kind in NUMERIC_TYPES else F.lit(None)).cast("double").alias("number"),
                (F.col(name) if kind in WHOLE_TYPES else F.lit(None)).cast("decimal(20,0)").alias("whole"),
            )
        )
    if key:
        kinds = dict(df.dtypes)
        parts = F.to_json(F.struct(*[_text(name, kinds[name]).alias(str(i)) for i, name in enumerate(key)]))
        none = F.lit(None)
        cells.append(
            F.struct(
                F.lit(-1).alias("at"), _cell_key(parts).alias("value"), none.cast("double").alias("number"), none.cast("decimal(20,0)").alias("whole")
            )
        )
    return df.select(F.inline(F.array(*cells)))


def profile_state(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(at, value, rows, number, whole): how often each column has each value, from one pass over ``df``.

    Frequent values are combined before the shuffle. States of parts of a table, by day for instance, can be
    stored and merged; any statistic of the whole follows from the merged state.
    """
    return _cells(df, key).groupBy("at", "value").agg(
        F.count("*").alias("rows"), F.max("number").alias("number"), F.max("whole").alias("whole")
    )


def merged_states(*states: DataFrame) -> DataFrame:
    """The state of all parts together."""
    every = reduce(DataFrame.unionByName, states)
    return every.groupBy("at", "value").agg(
        F.sum("rows").alias("rows"), F.max("number").alias("number"), F.max("whole").alias("whole")
    )


def _exact(value: Column) -> Column:
    return value.cast("string")


def _stats(state: DataFrame) -> DataFrame:
    """Statistics per column of a state; each value is weighed by its rows."""
    blank = F.col("value").isNull() | (F.trim("value") == "")
    present = F.sum(F.when(F.col("number").isNotNull(), F.col("rows")))
    sums = state.groupBy("at").agg(
        present.alias("present"),
        F.sum(F.col("whole") * F.col("rows")).alias("whole_sum"),
        F.sum(F.col("number") * F.col("rows")).alias("number_sum"),
        F.sum("rows").alias("total_rows"),
        F.coalesce(F.sum(F.when(blank, F.col("rows"))), F.lit(0)).alias("null_count"),
        F.count("*").alias("distinct_count"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        _exact(F.min("whole")).alias("min_exact"),
        _exact(F.max("whole")).alias("max_exact"),
    )
    # A sum beyond the whole numbers of a double is divided as a whole number first.
    share = F.expr("whole_sum div present")
    rest = (F.col("whole_sum") - share.cast("decimal(19,0)") * F.col("present").cast("decimal(18,0)")).cast("double") / F.col("present")
    small = F.abs("whole_sum") < F.lit(1 << 53)
    whole = F.when(small, F.col("whole_sum").cast("double") / F.col("present")).otherwise(share.cast("double") + rest)
    mean = F.when(F.col("whole_sum").isNotNull(), whole).otherwise(F.col("number_sum") / F.col("present"))
    return sums.withColumn("mean", F.round(mean, 4)).drop("present", "whole_sum", "number_sum")


def _approximate_stats(df: DataFrame, key: list[str] | None) -> DataFrame:
    """The same without counting values, so without a shuffle of values; distinct values by a sketch."""
    blank = F.col("value").isNull() | (F.trim("value") == "")
    return _cells(df, key).groupBy("at").agg(
        F.count("*").alias("total_rows"),
        F.count_if(blank).alias("null_count"),
        (F.approx_count_distinct("value") + F.max(F.col("value").isNull().cast("int"))).alias("distinct_count"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        F.round(F.avg("number"), 4).alias("mean"),
        _exact(F.min("whole")).alias("min_exact"),
        _exact(F.max("whole")).alias("max_exact"),
    )


def _placed_stats(stats: DataFrame, columns: list[str], key: list[str] | None = None) -> DataFrame:
    """One row per column, also of a table without rows; the key's is at -1."""
    places = [(-1, "")] * bool(key) + list(enumerate(columns))
    listed = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(name).alias("column")) for i, name in places])
    names = stats.sparkSession.range(1).select(F.inline(listed))
    zero = F.lit(0).cast("long")
    return names.join(stats, "at", "left").select(
        "at",
        "column",
        F.coalesce("total_rows", zero).alias("total_rows"),
        F.coalesce("null_count", zero).alias("null_count"),
        _percent(F.col("null_count"), F.col("total_rows")).alias("null_pct"),
        F.coalesce("distinct_count", zero).alias("distinct_count"),
        "min",
        "max",
        "mean",
        "min_exact",
        "max_exact",
    )


def column_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: nulls or blanks, distinct values, numeric range and mean.

    Null counts as one distinct value. Exact distinct counts shuffle the
    distinct values of every column; ``approximate`` avoids that.
    """
    return exact_column_stats(df, approximate).drop("min_exact", "max_exact")


def exact_column_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """``column_stats`` with the least and largest whole number as text, which doubles above 2 ** 53 are not."""
    stats = _approximate_stats(df, None) if approximate else _stats(profile_state(df))
    return _placed_stats(stats, df.columns).drop("at", "total_rows")


def stats_of_state(state: DataFrame, columns: list[str]) -> DataFrame:
    """``exact_column_stats`` from a stored or merged state of a table with these columns."""
    return _placed_stats(_stats(state.filter("at >= 0")), columns).drop("at", "total_rows")


def key_duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: total, distinct and surplus rows on ``key``."""
    groups = df.groupBy(*key).agg(F.count("*").alias("rows"))
    totals = groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_rows")
    )
    surplus = F.col("total_rows") - F.col("distinct_rows")
    return totals.select(
        F.array(*[F.lit(name) for name in key]).alias("key_columns"),
        "total_rows",
        "distinct_rows",
        surplus.alias("duplicate_rows"),
        _percent(surplus, F.col("total_rows")).alias("duplicate_pct"),
    )


def quality_score(avg_null_pct: Column, duplicate_pct: Column) -> Column:
    """1 minus half of each share, kept within 0 and 1."""
    score = F.lit(1.0) - (avg_null_pct / 100.0 * 0.5 + duplicate_pct / 100.0 * 0.5)
    return round_half_up(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4)


def quality_report(df: DataFrame, key: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """The whole report as one nested row, from one pass over ``df``."""
    if key is None:
        key = ["content_id"] if "content_id" in df.columns else df.columns[:1]
    stats = _approximate_stats(df, key) if approximate else _stats(profile_state(df, key))
    return report_of_stats(stats, df.columns, key)


def report_of_state(state: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """The report from a stored or merged state that was taken with this key."""
    return report_of_stats(_stats(state), columns, key)


def report_of_stats(stats: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    # One entry per column of the table and one for the key: a list as short as its schema.
    listed = _placed_stats(stats, columns, key).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("all"))
    whole = F.get("all", F.lit(0))
    total, distinct = whole["total_rows"], whole["distinct_count"]
    duplicates = F.struct(
        F.array(*[F.lit(name) for name in key]).alias("key_columns"),
        total.alias("total_rows"),
        distinct.alias("distinct_rows"),
        (total - distinct).alias("duplicate_rows"),
        _percent(total - distinct, total).alias("duplicate_pct"),
    )
    joined = listed.select(
        F.transform(F.slice("all", 2, len(columns)), lambda c: c.dropFields("at", "total_rows")).alias("columns"),
        duplicates.alias("duplicates"),
    )
    null_pct = F.aggregate("columns", F.lit(0.0), lambda total, c: total + c["null_pct"]) / F.size("columns")
    return joined.select(
        F.col("duplicates.total_rows").alias("total_rows"),
        F.size("columns").alias("column_count"),
        "columns",
        "duplicates",
        quality_score(null_pct, F.col("duplicates.duplicate_pct")).alias("quality_score"),
    )


def quality_band(score: Column) -> Column:
    return F.when(score >= 0.9, "good").when(score >= 0.7, "fair").otherwise("poor")


def flagged_columns(stats: DataFrame, alert: float = NULL_PCT_ALERT) -> DataFrame:
    """Null share per column with a flag over the alert level."""
    return stats.select(
        "column", "null_count", "null_pct", "distinct_count", (F.col("null_pct") > alert).alias("over_alert")
    )
