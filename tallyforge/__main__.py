"""``spark-submit``-able batch: ``python -m tallyforge FILE... [--database NAME]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyforge.plans.batch import run_batch


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyforge", description=run_batch.__doc__)
    parser.add_argument("files", nargs="+", help="order, product and customer files")
    parser.add_argument("--database", default="default", help="database of the tables")
    parser.add_argument("--strict", action="store_true", help="use the strict validation rules")
    form = parser.add_mutually_exclusive_group()
    form.add_argument("--json-lines", dest="multiline", action="store_false", help="orders are JSON Lines")
    form.add_argument("--json-array", dest="multiline", action="store_true", help="orders are arrays")
    parser.add_argument("--allow-existing", action="store_true", help="use bronze tables of an earlier run")
    parser.set_defaults(multiline=None)
    options = parser.parse_args()

    spark = SparkSession.builder.appName("tallyforge").getOrCreate()
    manifest = run_batch(
        spark,
        options.files,
        options.database,
        options.strict,
        options.multiline,
        allow_existing=options.allow_existing,
    )
    manifest.show(truncate=False)


if __name__ == "__main__":
    main()
