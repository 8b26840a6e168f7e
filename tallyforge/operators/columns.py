"""Column renaming and the guards that check a frame's columns and types."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def sanitized(name: str) -> str:
    """Spaces and hyphens become underscores, other outer white space goes."""
    return name.translate(str.maketrans(" -", "__")).strip()


def sanitize_cols(df: DataFrame) -> DataFrame:
    """Rename all columns by the rule of ``sanitized``.

    Two columns that would end up with the same name (Spark ignores case) raise here rather
    than in the write that follows.
    """
    renamed = [sanitized(name) for name in df.columns]
    counts = Counter(name.lower() for name in renamed)
    clashes = sorted(old for old, new in zip(df.columns, renamed) if counts[new.lower()] > 1)
    if clashes:
        raise ValueError(f"columns get the same name once sanitized: {clashes}")
    return df.toDF(*renamed)


def require_columns(df: DataFrame, needed, frame: str = "frame") -> DataFrame:
    """Return ``df`` unchanged, or raise with the names of all columns it lacks."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in needed if name.lower() not in present]
    if missing:
        raise ValueError(f"{frame} lacks the columns {missing}; it has {df.columns}")
    return df


def type_mismatches(df: DataFrame, declared: dict[str, str]) -> list[tuple[str, str, str]]:
    """``(column, actual type, declared type)`` for each declared column of another type."""
    actual = {name.lower(): kind for name, kind in df.dtypes}
    return [
        (name, actual[name.lower()], kind)
        for name, kind in declared.items()
        if name.lower() in actual and actual[name.lower()] != kind
    ]
