"""Where intermediate tables go, how they are removed, and how workers get the package."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

_folders: list[str] = []
_databases: list[str] = []
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the one the session gives in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. On a cluster such a
    folder would differ from machine to machine, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="tallyforge-")
    folder = f"{base.rstrip('/')}/tallyforge-{uuid4().hex}"
    _folders.append(folder)
    return folder


def scratch_database(spark: SparkSession) -> str:
    """Create a database with a fresh name whose tables live in a new shared folder."""
    name = f"tallyforge_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}'")
    _databases.append(name)
    return name


def clean_up(spark: SparkSession) -> None:
    """Drop the databases and delete the folders that this process made.

    Frames that queries returned read them, so this is for when the results are no longer used.
    """
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
    while _folders:
        delete_folder(spark, _folders.pop())


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there, in whatever store it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, so that functions which run there
    find it wherever they were started."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        name = f"{tempfile.mkdtemp(prefix='tallyforge-')}/{package.name}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
