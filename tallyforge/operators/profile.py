"""Column profiles: what a table's columns hold, in one pass, as sketches that can be merged.

For each column: rows, NULLs, values that do not convert to the declared type with the smallest of
them, and the range of its measure, which is the number, the day or, for text, the characters.
Distinct values, the distribution of the measure and the most frequent values are kept as
sketches of fixed size, so profiles of days or partitions add up to that of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.columns import require_columns
from tallyforge.operators.orders import ORDER_DATE_FORMAT

#: Logarithm of the buckets of the sketch of distinct values: relative error about 0.8 / 2^(BITS / 2).
BITS = 14
#: Size of the sketch of quantiles: rank error about 1.3 % at 200.
QUANTILES_K = 200
#: Values the sketch of frequent ones follows: counts are off by at most 1 / TRACKED of the rows,
#: as the sketch holds three quarters of that many.
TRACKED = 1024
TOP = 5
NUMBERS = ("int", "bigint", "double")

EXACT = ["column_name", "target_type", "n", "n_null", "n_failed", "smallest_failed", "least", "greatest"]


def typed(column: str, kind: str) -> Column:
    """A column as its declared type, NULL where a value does not convert."""
    value = F.col(f"`{column}`")
    if kind == "date":
        return F.try_to_date(value.cast("string"), ORDER_DATE_FORMAT)
    return value.try_cast(kind)


def measure(column: str, kind: str) -> Column:
    value = typed(column, kind)
    if kind == "date":
        return F.unix_date(value).cast("double")
    return value.cast("double") if kind in NUMBERS else F.length(value).cast("double")


def column_profile(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """A row for each declared column, its type one of ``string``, ``date`` (as order files write
    it), ``int``, ``bigint`` and ``double``. A frame without rows has a row for each column too."""
    require_columns(df, declared, "profiled frame")
    found = []
    for i, (name, kind) in enumerate(declared.items()):
        value = F.col(f"`{name}`")
        text, size = value.cast("string"), measure(name, kind)
        failed = value.isNotNull() & typed(name, kind).isNull()
        found += [
            F.count(F.lit(1)).alias(f"n_{i}"),
            F.count_if(value.isNull()).alias(f"n_null_{i}"),
            F.count_if(failed).alias(f"n_failed_{i}"),
            F.min(F.when(failed, text)).alias(f"smallest_failed_{i}"),
            F.min(size).alias(f"least_{i}"),
            F.max(size).alias(f"greatest_{i}"),
            F.hll_sketch_agg(text, BITS).alias(f"distinct_{i}"),
            F.call_function("kll_sketch_agg_double", size, F.lit(QUANTILES_K)).alias(f"quantiles_{i}"),
            F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias(f"frequent_{i}"),
        ]
    parts = ["n", "n_null", "n_failed", "smallest_failed", "least", "greatest", "distinct", "quantiles", "frequent"]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("target_type"),
            *[F.col(f"{part}_{i}").alias(part) for part in parts],
        )
        for i, (name, kind) in enumerate(declared.items())
    ]
    return df.agg(*found).select(F.inline(F.array(*rows)))


def merged(profiles: DataFrame) -> DataFrame:
    """One profile from several of frames with the same columns, their rows in one frame."""
    return profiles.groupBy("column_name", "target_type").agg(
        *[F.sum(c).alias(c) for c in ("n", "n_null", "n_failed")],
        F.min("smallest_failed").alias("smallest_failed"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("kll_merge_agg_double", "quantiles").alias("quantiles"),
        F.call_function("approx_top_k_combine", "frequent", F.lit(TRACKED)).alias("frequent"),
    )


def estimates(profile: DataFrame, top: int = TOP) -> DataFrame:
    """The exact columns of a profile, and what its sketches say: ``n_distinct``, the ``quartiles`` of
    the measure (NULL without a value), and the ``top`` values with their counts."""
    known = F.col("least").isNotNull()
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = F.call_function("kll_sketch_get_quantile_double", "quantiles", quarters)
    return profile.select(
        *EXACT,
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.when(known, quartiles).alias("quartiles"),
        F.call_function("approx_top_k_estimate", "frequent", F.lit(top)).alias("most_frequent"),
    )
