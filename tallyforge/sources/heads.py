"""Which form of JSON a file holds, from its first bytes, without reading the rest of it."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One JSON value over the whole file; one on each line; no value at all; neither; not opened.
WHOLE, LINES, EMPTY, NEITHER, UNREAD = "whole", "lines", "empty", "neither", "unread"

BLANK = b" \t\r\x0b\x0c"
BOM = b"\xef\xbb\xbf"
CHUNK = 1 << 16
#: Compressed files that are read to their end before they are loaded; see ``damaged``.
PROBED = (".gz", ".bz2")


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path``, ``length`` and ``modified`` of every file at the paths, each a file, a folder or a
    pattern. Nothing of their content is read. Spark leaves out files of no bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def form_of(chunks: Iterator[bytes]) -> str:
    """The form that the first line which is not blank tells.

    ``[`` begins an array, unless the line also ends it and another line follows: then each line
    is an array of its own. ``{`` alone on its line begins an object that spans lines.
    """
    head = b""  # the first line's text, at most two characters of it
    last = 0  # the last character of it that is not blank
    begun: bytes | None = b""  # what may be part of a byte order mark
    ended = False
    for chunk in chunks:
        if begun is not None:
            begun += chunk
            if len(begun) < len(BOM) and BOM.startswith(begun):
                continue
            chunk, begun = begun.removeprefix(BOM), None
        while chunk:
            line, feed, chunk = chunk.partition(b"\n")
            text = line.strip(BLANK)
            if ended and text:
                return LINES
            if text:
                head = (head + text)[:2]
                last = text[-1]
                if head[:1] not in (b"[", b"{"):
                    return NEITHER
                if head[:1] == b"{" and len(head) == 2:
                    return LINES
            if feed and head:
                if head == b"{" or last != ord("]"):
                    return WHOLE
                ended = True
    if not head:
        return EMPTY
    return WHOLE


def chunks_of(path: str) -> Iterator[bytes]:
    """The content of a file, decompressed by what its name ends with."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        store, inside = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        store, inside = fs.FileSystem.from_uri(quote(unquote(path), safe=":/@"))
    with store.open_input_stream(inside, compression="detect", buffer_size=CHUNK) as stream:
        while chunk := stream.read(CHUNK):
            yield chunk


def file_of_row() -> Column:
    """The path of the file a row comes from, as ``list_files`` gives it."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def forms(files: DataFrame) -> DataFrame:
    """Adds ``form`` to files listed by ``path``. A task opens each of its files and reads until the
    form is known, which is the first line at most. A file in a store that only Spark can open,
    or compressed in a way that only Spark knows, is ``unread``."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    found.append(form_of(chunks_of(path)))
                except (OSError, ValueError, NotImplementedError):
                    found.append(UNREAD)
            yield batch.append_column("form", pa.array(found, pa.string()))

    return files.mapInArrow(batches, ", ".join(f"{n} {t}" for n, t in [*files.dtypes, ("form", "string")]))


def damaged(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of the compressed files that cannot be decompressed to their end, or not be opened here.

    Decompressing takes a small part of what parsing takes. Tasks hold a chunk of a file at a time.
    """
    probed = [(p,) for p in paths if p.lower().endswith(PROBED)]
    if not probed:
        return set()

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            broken = []
            for path in batch.column("path").to_pylist():
                try:
                    for _ in chunks_of(path):
                        pass
                except (OSError, ValueError, NotImplementedError):
                    broken.append(path)
            yield pa.record_batch([pa.array(broken, pa.string())], names=["path"])

    tasks = min(len(probed), int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = spark.createDataFrame(probed, "path string").repartition(tasks)
    return {row.path for row in files.mapInArrow(batches, "path string").collect()}


def forms_by_scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path`` and ``form`` of the files at ``path`` through Spark's own reader, which reads all of
    every file, for those whose heads cannot be read."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    text = F.trim("value", F.lit("\ufeff \t\r\x0b\x0c"))
    # Ids rise within the part of a file that one task reads, and its beginning is in one part.
    starts = lines.filter((F.col("_metadata.file_block_start") == 0) & (text != "")).select(
        file_of_row().alias("path"),
        F.struct(F.left(text, F.lit(2)).alias("head"), F.right(text, F.lit(1)).alias("tail")).alias("ends"),
        F.monotonically_increasing_id().alias("id"),
    )
    first = starts.groupBy("path").agg(F.min_by("ends", "id").alias("ends"), F.count("*").alias("n"))
    start = F.left("ends.head", F.lit(1))
    form = (
        F.when((start == "[") & (F.col("ends.tail") == "]") & (F.col("n") > 1), LINES)
        .when((start == "[") | (F.col("ends.head") == "{"), WHOLE)
        .when(start == "{", LINES)
        .otherwise(NEITHER)
    )
    return first.select("path", form.alias("form"))
