"""Load each source file once, with an outcome for every file.

A bronze table that is loaded this way is a view on a folder with one partition per load. A ledger
beside it has a row for every file a load took: path, length, time of modification, and what
became of it. The next load lists the files and takes those the ledger does not have as they
are now. A file that cannot be read costs its own rows only: compressed files that break off are
found beforehand and written apart, the others of a load are written together, and where that
fails the group is cut until the file is found. Rows are seen once the
load is complete, by one change of the catalog; what an interrupted load left is removed by the
next. A file that was delivered again in another state replaces the rows it had brought.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import batched
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.columns import sanitize_cols, sanitized
from tallyforge.schemas import CUSTOMERS, ORDERS_FILE, PRODUCTS, ddl
from tallyforge.sinks.publish import database_folder, property_of, qualified, switch_to
from tallyforge.sources.files import (
    COMPRESSION,
    CORRUPT,
    FORMATS,
    read_customers,
    read_orders_json,
    read_products_csv,
)
from tallyforge.sources.heads import (
    EMPTY,
    NEITHER,
    UNREAD,
    WHOLE,
    damaged,
    file_of_row,
    forms,
    forms_by_scan,
    list_files,
)
from tallyforge.sources.ingest import ROUTES
from tallyforge.workspace import delete_folder, shared_folder

log = logging.getLogger(__name__)

LEDGER = (
    "path string, length bigint, modified timestamp, table_name string, status string, "
    "row_count bigint, corrupt_rows bigint, error string"
)
ENTRY = "path string, length bigint, modified timestamp, status string, error string"

SOURCES = {
    "bronze_orders": {sanitized(name): kind for name, kind in ORDERS_FILE.items()},
    "bronze_products": PRODUCTS,
    "bronze_customer": CUSTOMERS,
}
#: What is kept of a source's rows: their columns, their file, and whether they did not fit.
ROWS = {table: columns | {"_file": "string", "_corrupt": "boolean"} for table, columns in SOURCES.items()}

#: Files the driver names in one read; a load of more takes several.
FILES_AT_ONCE = 10_000
#: Characters of an error that are kept.
MESSAGE = 2000
#: Parts a group is cut into when writing it fails.
CUT = 8


@dataclass(frozen=True)
class Source:
    """A file to load: where it is, how long, when it was changed, and how it is to be read."""

    path: str
    length: int
    modified: object
    kind: str


# --- where a table's loads are ---------------------------------------------------------------


class Loads:
    """The loads of one bronze table: their folder, their ledger, and which of them count."""

    def __init__(self, spark: SparkSession, table: str, database: str):
        self.spark, self.table, self.database = spark, table, database
        base = database_folder(spark, database)
        self.folder, self.ledger_folder = f"{base}/{table}__files", f"{base}/{table}__ledger"
        self.last = int(property_of(spark, table, "load", database) or 0)
        replaced = property_of(spark, table, "replaced", database) or ""
        self.replaced = [int(n) for n in replaced.split(",") if n]

    def counts(self) -> Column:
        """Whether a row's load is complete and was not replaced."""
        done = F.col("_load") <= self.last
        return done & ~F.col("_load").isin(self.replaced) if self.replaced else done

    def rows(self, load: int | None = None) -> DataFrame:
        """The rows of one load, or of all that count, with the file each comes from."""
        schema = ddl(ROWS[self.table])
        if load is not None:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/_load={load}")
        return self.spark.read.schema(f"{schema}, _load int").parquet(self.folder).filter(self.counts())

    def ledger(self) -> DataFrame:
        """Every file of every complete load; those of replaced loads too, which tell what was seen."""
        if not self.last:
            return self.spark.createDataFrame([], f"{LEDGER}, _load int")
        schema = f"{LEDGER}, _load int"
        return self.spark.read.schema(schema).parquet(self.ledger_folder).filter(F.col("_load") <= self.last)

    def commit(self, load: int, replaced: Iterable[int]) -> None:
        self.last, self.replaced = load, sorted({*self.replaced, *replaced})
        names = ", ".join(f"`{c}`" for c in SOURCES[self.table])
        without = f" AND _load NOT IN ({', '.join(map(str, self.replaced))})" if self.replaced else ""
        query = f"SELECT {names} FROM parquet.`{self.folder}` WHERE _load <= {load}{without}"
        state = {"load": str(load), "replaced": ",".join(map(str, self.replaced))}
        switch_to(self.spark, self.table, query, self.database, **state)


def ledger(spark: SparkSession, table: str, database: str = "default") -> DataFrame:
    """The files a bronze table was loaded from, load by load."""
    return Loads(spark, table, database).ledger()


# --- what is to be loaded --------------------------------------------------------------------


def routed(path: Column) -> Column:
    """The table a file's path names; the first match wins, and no match is NULL."""
    found = F.lit(None).cast("string")
    for text, table in reversed(ROUTES.items()):
        found = F.when(path.contains(text), table).otherwise(found)
    return found


def fresh_files(files: DataFrame, seen: DataFrame) -> DataFrame:
    """The files that the ledger does not have as they are now."""
    loaded = seen.filter("status = 'loaded'").groupBy("path")
    last = loaded.agg(F.max_by(F.struct("length", "modified"), "_load").alias("was"))
    same = (F.col("now.path") == F.col("then.path")) & F.col("then.was").eqNullSafe(
        F.struct(F.col("now.length").alias("length"), F.col("now.modified").alias("modified"))
    )
    return files.alias("now").join(last.alias("then"), same, "left_anti")


def with_kind(files: DataFrame, table: str) -> DataFrame:
    """Adds ``kind``, how a file is to be read: by its ending, and orders by their first line."""
    ending = F.regexp_extract(F.lower("path"), rf"\.([^./]+?)(\.({COMPRESSION}))?$", 1)
    by_ending = F.lit(None).cast("string")
    for text, kind in FORMATS.items():
        by_ending = F.when(ending == text, kind).otherwise(by_ending)
    named = files.withColumn("kind", F.coalesce(by_ending, F.concat(F.lit("unknown ending "), ending)))
    if table != "bronze_orders":
        return named
    json = F.col("kind") == "json"
    told = forms(named.filter(json).drop("kind")).withColumnRenamed("form", "kind")
    return told.unionByName(named.filter(~json))


ACCEPTED = {
    "bronze_orders": {WHOLE, "lines", EMPTY},
    "bronze_products": {"csv"},
    "bronze_customer": {"csv", "parquet"},
}


def escaped(path: str) -> str:
    """A path that Spark does not take for a pattern."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in path)


def read_files(spark: SparkSession, table: str, kind: str, paths: list[str], options: dict) -> DataFrame:
    """The rows of files of one kind, with sanitized names, their file and whether they fit."""
    places = [escaped(p) for p in paths]
    if table == "bronze_orders":
        rows = read_orders_json(spark, places, kind == WHOLE, corrupt=True, **options)
    elif table == "bronze_products":
        rows = read_products_csv(spark, places, corrupt=True, **options)
    else:
        rows = read_customers(spark, places, corrupt=True, form=kind, **options)
    rows = sanitize_cols(rows.withColumn("_file", file_of_row()))
    return rows.withColumn("_corrupt", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def write_apart(files: list[Source], write: Callable[[list[Source]], None]) -> Iterator[tuple[Source, str]]:
    """Write files together. Where that fails, the group is cut and its parts are written, until
    each file that cannot be read is alone; those are returned with the error.

    The file that an error names is tried alone at once, so one bad file costs about one more
    write of its group.
    """
    waiting = [files]
    while waiting:
        group = waiting.pop()
        try:
            write(group)
            continue
        except Exception as failure:  # whatever is wrong with a file must not cost the others
            message = str(failure)
        if len(group) == 1:
            message = "\n".join(line for line in message.splitlines() if not line.startswith("\tat "))
            log.error("could not load %s: %s", group[0].path, message)
            yield group[0], message[:MESSAGE]
            continue
        names = {f: f.path.rsplit("/", 1)[-1] for f in group}
        named = [f for f in group if names[f] in message or quote(names[f]) in message]
        rest = [f for f in group if f not in named] if len(named) < len(group) else group
        if rest is not group:
            waiting += [[f] for f in named]
        size = -(-len(rest) // CUT)
        waiting += [rest[at : at + size] for at in range(0, len(rest), size)]


# --- a load ---------------------------------------------------------------------------------------


def load_fresh(loads: Loads, fresh: DataFrame, options: dict, files_at_once: int) -> DataFrame | None:
    """Load the files of ``fresh`` and return their ledger rows; ``None`` if there are none."""
    spark, table, load = loads.spark, loads.table, loads.last + 1
    into = f"{loads.folder}/_load={load}"
    delete_folder(spark, into)  # of a load that was interrupted
    delete_folder(spark, f"{loads.ledger_folder}/_load={load}")
    entries_at = shared_folder(spark)
    found = False

    def write(files: list[Source]) -> None:
        rows = read_files(spark, table, files[0].kind, [f.path for f in files], options)
        rows.write.mode("append").parquet(into)

    def note(outcomes: list[tuple[Source, str | None]]) -> None:
        rows = [(f.path, f.length, f.modified, "error" if e else "loaded", e) for f, e in outcomes]
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(entries_at)

    listed = with_kind(fresh, table).select("path", "length", "modified", "kind").orderBy("path")
    for rows in batched(listed.toLocalIterator(), files_at_once):
        found = True
        sources = told_by_scan(spark, [Source(*row) for row in rows])
        by_kind: dict[str, list[Source]] = {}
        for source in sources:
            by_kind.setdefault(source.kind, []).append(source)
        for kind, files in by_kind.items():
            if kind not in ACCEPTED[table]:
                wrong = "neither an array of orders nor JSON Lines" if kind == NEITHER else kind
                note([(f, wrong) for f in files])
                continue
            # Those that will hardly be read are not written with the others, which would all be
            # written again. With a single file there is nothing to spare.
            doubtful = damaged(spark, [f.path for f in files]) if len(files) > 1 else set()
            failed: dict[Source, str] = {}
            for group in ([f for f in files if f.path not in doubtful], [f for f in files if f.path in doubtful]):
                if group:
                    failed |= dict(write_apart(group, write))
            note([(f, failed.get(f)) for f in files])
    if not found:
        return None

    entries = spark.read.schema(ENTRY).parquet(entries_at)
    # So that the folder and its columns are there even if the load has no row.
    spark.createDataFrame([], ddl(ROWS[table])).coalesce(1).write.mode("append").parquet(into)
    staged = loads.rows(load).groupBy("_file").agg(
        F.count("*").alias("row_count"), F.count_if("_corrupt").alias("corrupt_rows")
    )
    counted = entries.join(staged, entries.path == staged._file, "left")
    loaded = F.col("status") == "loaded"
    counted = counted.select(
        "path",
        "length",
        "modified",
        F.lit(table).alias("table_name"),
        "status",
        F.when(loaded, F.coalesce("row_count", F.lit(0))).alias("row_count"),
        F.when(loaded, F.coalesce("corrupt_rows", F.lit(0))).alias("corrupt_rows"),
        "error",
    )
    counted.write.parquet(f"{loads.ledger_folder}/_load={load}")
    loads.commit(load, replace_old_rows(loads, load))
    return loads.ledger().filter(F.col("_load") == load).drop("_load")


def told_by_scan(spark: SparkSession, sources: list[Source]) -> list[Source]:
    """The same files, those whose heads could not be read told by Spark's own reader."""
    unread = [escaped(s.path) for s in sources if s.kind == UNREAD]
    if not unread:
        return sources
    told = {row.path: row.form for row in forms_by_scan(spark, unread).collect()}
    return [
        s if s.kind != UNREAD else Source(s.path, s.length, s.modified, told.get(s.path, EMPTY)) for s in sources
    ]


def replace_old_rows(loads: Loads, load: int) -> list[int]:
    """Where ``load`` brought a file again, take the rows of the other files of the loads that had
    it over into ``load``, and return those loads, which then no longer count."""
    if not loads.last:
        return []
    now = loads.spark.read.schema(LEDGER).parquet(f"{loads.ledger_folder}/_load={load}")
    again = now.filter("status = 'loaded'").select(F.col("path").alias("_again"))
    had = loads.ledger().filter("status = 'loaded'")
    if had.join(again, F.col("path") == F.col("_again"), "left_semi").isEmpty():
        return []  # rows come from files of the ledger only, which is far shorter
    before = loads.rows()
    touched = before.join(again, before._file == F.col("_again"), "left_semi").select("_load").distinct()
    old = sorted(row._load for row in touched.collect())
    if old:
        kept = before.filter(F.col("_load").isin(old)).join(again, before._file == F.col("_again"), "left_anti")
        kept.drop("_load").write.mode("append").parquet(f"{loads.folder}/_load={load}")
    return old


def ingest_new_files(
    spark: SparkSession,
    paths: Iterable[str],
    database: str = "default",
    options: dict | None = None,
    files_at_once: int = FILES_AT_ONCE,
) -> DataFrame:
    """Load the files at ``paths`` that were not loaded before, and return a manifest with a row for
    each of them: path, length, time, table, status, rows, rows that do not fit, error.

    A path is a file, a folder or a pattern; what a file is, its own path says. Files that failed
    before are tried again. ``options`` holds keyword arguments of the readers by table. One load
    at a time may run for a table.
    """
    errors, readable = [], []
    for path in paths:
        try:
            list_files(spark, path).limit(0).collect()
            readable.append(path)
        except Exception as failure:  # one bad path must not stop the others
            log.error("could not list %s: %s", path, failure)
            errors.append((path, None, None, None, "error", None, None, str(failure)))
    manifest = [spark.createDataFrame(errors, LEDGER)]
    if readable:
        files = list_files(spark, *readable).distinct().withColumn("table_name", routed(F.col("path")))
        stored = shared_folder(spark)
        files.write.parquet(stored)  # one listing for all tables
        files = spark.read.schema(files.schema).parquet(stored)
        unknown = files.filter("table_name IS NULL").select(
            "path", "length", "modified", "table_name", F.lit("error").alias("status"),
            F.lit(None).cast("bigint").alias("row_count"), F.lit(None).cast("bigint").alias("corrupt_rows"),
            F.lit("unknown kind of file").alias("error"),
        )
        manifest.append(unknown)
        for table in ROUTES.values():
            loads = Loads(spark, table, database)
            fresh = fresh_files(files.filter(F.col("table_name") == table).drop("table_name"), loads.ledger())
            found = load_fresh(loads, fresh, (options or {}).get(table, {}), files_at_once)
            if found is not None:
                manifest.append(found)
                spark.table(qualified(table, database)).createOrReplaceTempView(f"{table}_loaded")
    return reduce(DataFrame.unionByName, manifest)
