"""Bloom filters in the files of a table, for lookups by a column it is not laid out by."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relative error allowed to the sketch that counts distinct values.
ERROR = 0.05


def bloom_options(df: DataFrame, columns: list[str], files: int, false_positives: float = 0.01) -> dict[str, str]:
    """Options of the Parquet writer that give each row group a Bloom filter for ``columns``.

    A filter is sized for the distinct values a file can hold: those of the whole frame, counted
    by a sketch, or the rows of a file if these are fewer.
    """
    found = df.agg(F.count("*"), *[F.approx_count_distinct(F.col(f"`{c}`"), ERROR) for c in columns]).first()
    rows = -(-found[0] // files)
    options = {}
    for column, distinct in zip(columns, found[1:]):
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(max(1, min(rows, distinct)))
        options[f"parquet.bloom.filter.fpp#{column}"] = str(false_positives)
    return options
