"""File scans with fixed schemas; nothing is inferred."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.schemas import CUSTOMERS, ORDERS_FILE, PRODUCTS, ddl
from tallyforge.sources.heads import (
    LINES,
    NEITHER,
    UNREAD,
    WHOLE,
    file_of_row,
    forms,
    forms_by_scan,
    list_files,
)

# The text after a file's last full stop, behind which a compression may follow.
FORMATS = {
    "json": "json", "jsonl": "json", "ndjson": "json", "csv": "csv", "txt": "csv", "parquet": "parquet",
}
COMPRESSION = "gz|bz2|zst|zstd|snappy|lz4|deflate"
CORRUPT = "_corrupt_record"


def file_format(spark: SparkSession, path: str, *accepted: str) -> str:
    """The one format of all files at ``path``, which may be a file, a folder or a pattern.

    No file, an unknown ending, several formats, or one that is not ``accepted`` raises.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).inputFiles()
    if not files:
        raise FileNotFoundError(f"no file at {path}")
    ends = [re.search(rf"\.([^./]+?)(\.({COMPRESSION}))?$", name.lower()) for name in files]
    endings = {end[1] if end else "" for end in ends}
    found = {FORMATS.get(ending, f"unknown ending '{ending}'") for ending in endings}
    if len(found) > 1 or not found <= set(accepted):
        raise ValueError(f"{path} holds {sorted(found)}; one of {list(accepted)} is read")
    return found.pop()


def order_forms(spark: SparkSession, path: str) -> tuple[dict[str, int], DataFrame]:
    """How many files at ``path`` are of each form of JSON, and ``path`` and ``form`` of each.

    Tasks open the files and read their first lines; only where they cannot does Spark's own
    reader go through the files.
    """
    found = forms(list_files(spark, path).select("path"))  # some dozens of files to a task
    counts = _counts(found)
    if UNREAD in counts:
        found = forms_by_scan(spark, path)
        counts = _counts(found)
    return counts, found


def _counts(found: DataFrame) -> dict[str, int]:
    return {row["form"]: row["count"] for row in found.groupBy("form").count().collect()}


def read_orders_json(
    spark: SparkSession, path: str | list[str], multiline: bool | None = None, corrupt: bool = False
) -> DataFrame:
    """Orders from JSON. Fields match by exact name; a value of another type becomes NULL.

    ``multiline`` reads files that hold one array of orders, each in a single task: supply many
    such files, or JSON Lines, which Spark splits. By default each file is read in its own form;
    where both occur, the driver holds the paths of the rarer one, and a file that is of neither
    raises. ``corrupt`` adds a column with the text of orders that do not fit the schema.
    """
    if multiline is not None:
        return _reader(spark, ORDERS_FILE, corrupt).json(path, multiLine=multiline)
    counts, found = order_forms(spark, path)
    if NEITHER in counts:
        wrong = found.filter(F.col("form") == NEITHER).orderBy("path").limit(10).collect()
        raise ValueError(f"neither an array of orders nor JSON Lines: {[row.path for row in wrong]}")
    if not (WHOLE in counts and LINES in counts):
        return _reader(spark, ORDERS_FILE, corrupt).json(path, multiLine=WHOLE in counts)
    rarer = min(WHOLE, LINES, key=counts.get)
    listed = file_of_row().isin([row.path for row in found.filter(F.col("form") == rarer).collect()])
    # The condition is on the path alone, so files of the other form are not opened.
    parts = [(rarer, listed), (LINES if rarer == WHOLE else WHOLE, ~listed)]
    frames = [_reader(spark, ORDERS_FILE, corrupt).json(path, multiLine=f == WHOLE).filter(own) for f, own in parts]
    return frames[0].unionByName(frames[1])


def read_products_csv(
    spark: SparkSession,
    path: str | list[str],
    check_header: bool = False,
    doubled_quotes: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """Products from CSV with a header line. Columns are bound by position.

    ``check_header`` makes a header with other names or another order an error, and
    ``doubled_quotes`` reads ``""`` inside a quoted value as one quote. ``corrupt`` adds a column
    with the text of rows with too few or too many values.
    """
    options = {"escape": '"'} if doubled_quotes else {}
    reader = _reader(spark, PRODUCTS, corrupt).options(**options)
    return reader.csv(path, header=True, enforceSchema=not check_header)


def read_customers(
    spark: SparkSession,
    path: str | list[str],
    check_header: bool = False,
    doubled_quotes: bool = True,
    corrupt: bool = False,
    form: str | None = None,
) -> DataFrame:
    """Customers from CSV with a header line, or from Parquet, as the files' endings say, unless
    ``form`` says it."""
    if (form or file_format(spark, path, "csv", "parquet")) == "parquet":
        rows = spark.read.schema(ddl(CUSTOMERS)).parquet(*[path] if isinstance(path, str) else path)
        return rows.withColumn(CORRUPT, F.lit(None).cast("string")) if corrupt else rows
    options = {"escape": '"'} if doubled_quotes else {}
    reader = _reader(spark, CUSTOMERS, corrupt).options(**options)
    return reader.csv(path, header=True, enforceSchema=not check_header)


def _reader(spark: SparkSession, schema: dict[str, str], corrupt: bool):
    columns = schema | {CORRUPT: "string"} if corrupt else schema
    reader = spark.read.schema(ddl(columns)).option("recursiveFileLookup", "true")
    return reader.option("columnNameOfCorruptRecord", CORRUPT)


def read_table_path(spark: SparkSession, path: str) -> DataFrame:
    """A table read by its folder rather than by its name."""
    return spark.read.parquet(path)
