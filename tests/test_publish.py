"""Tables that change all at once: failed builds, readers in between, versions."""

import pytest
from pyspark.sql import functions as F

from tallyforge.plans import batch, catalog
from tallyforge.sinks import publish as p
from tallyforge.sinks.tables import (
    drop_table,
    overwrite_clustered,
    overwrite_partitioned,
    overwrite_table,
)

SF_DIR = "/root/testdata/sf0.001"


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select("id", (F.col("id") % 3).cast("int").alias("k"))


def failing(spark, n=5):
    """Rows of which the last cannot be made, so that tasks before it have written theirs."""
    bad = F.raise_error(F.lit("no such row")).cast("bigint")
    return spark.range(0, n, 1, n).select(F.when(F.col("id") == n - 1, bad).otherwise(F.col("id")).alias("id"), F.lit(1).alias("k"))


def ids(df):
    return sorted(r.id for r in df.collect())


WRITERS = {
    "plain": overwrite_table,
    "partitioned": lambda df, t, db: overwrite_partitioned(df, t, "k", db),
    "clustered": lambda df, t, db: overwrite_clustered(df, t, "id", db),
}


@pytest.mark.parametrize("kind", WRITERS)
def test_failed_overwrite_keeps_the_table(spark, database, kind):
    write = WRITERS[kind]
    write(numbers(spark, 5), "t", database)
    before = p.current_version(spark, "t", database)
    with pytest.raises(Exception, match="no such row"):
        write(failing(spark), "t", database)
    assert ids(spark.table(f"{database}.t")) == [0, 1, 2, 3, 4]
    assert p.current_version(spark, "t", database) == before
    assert p.versions(spark, "t", database) == [before]
    write(numbers(spark, 2), "t", database)
    assert ids(spark.table(f"{database}.t")) == [0, 1]


def test_failed_first_build_leaves_nothing(spark, database, tmp_path):
    with pytest.raises(Exception, match="no such row"):
        overwrite_table(failing(spark), "t", database)
    assert not spark.catalog.tableExists(f"{database}.t") and p.versions(spark, "t", database) == []
    folder = p.database_folder(spark, database).removeprefix("file:")
    import os

    assert not os.path.isdir(folder) or not [f for f in os.listdir(folder) if f.startswith("t__v")]


def test_a_check_refuses_a_version(spark, database):
    p.publish(numbers(spark, 5), "t", database)

    def not_empty(df):
        if df.isEmpty():
            raise ValueError("empty")

    with pytest.raises(ValueError, match="empty"):
        p.publish(numbers(spark, 0), "t", database, check=not_empty)
    assert spark.table(f"{database}.t").count() == 5
    p.publish(numbers(spark, 1), "t", database, check=not_empty)
    assert spark.table(f"{database}.t").count() == 1


def test_lost_rows_are_noticed(spark, database, monkeypatch):
    p.publish(numbers(spark, 5), "t", database)
    whole = spark.range(7)

    class Counter:
        get = {"n": 8}

    monkeypatch.setattr(p, "Observation", Counter)
    monkeypatch.setattr(type(whole), "observe", lambda self, *_: self)
    with pytest.raises(p.PublishError, match="holds 7 rows, but 8 were written"):
        p.publish(whole, "t", database)
    assert spark.table(f"{database}.t").count() == 5


def test_readers_in_between(spark, database):
    """While a build is under way the old rows are read, also by a frame made before, and such a
    frame still reads them after the switch."""
    overwrite_partitioned(numbers(spark, 6), "t", "k", database)
    before = spark.table(f"{database}.t")
    seen = []

    def look(made):
        seen.append((ids(spark.table(f"{database}.t")), ids(before), ids(made)))

    p.publish(numbers(spark, 3, 100), "t", database, "k", check=look)
    assert seen == [([0, 1, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5], [100, 101, 102])]
    assert ids(spark.table(f"{database}.t")) == [100, 101, 102]
    assert ids(before) == [0, 1, 2, 3, 4, 5]


def test_table_rewritten_from_itself(spark, database):
    overwrite_table(numbers(spark, 4), "t", database)
    now = spark.table(f"{database}.t")
    overwrite_table(now.unionByName(now), "t", database)
    assert ids(spark.table(f"{database}.t")) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_rollback_and_expiry(spark, database):
    made = [p.publish(numbers(spark, n), "t", database) for n in (1, 2, 3)]
    assert p.versions(spark, "t", database) == made[1:]
    assert p.rollback(spark, "t", database) == made[1]
    assert spark.table(f"{database}.t").count() == 2
    with pytest.raises(ValueError, match="no version before"):
        p.rollback(spark, "t", database)
    with pytest.raises(ValueError, match="no version x"):
        p.rollback(spark, "t", database, to="x")
    # The current version stays however old it is.
    p.expire(spark, "t", database, keep=1)
    assert p.versions(spark, "t", database) == made[1:]
    assert p.rollback(spark, "t", database, to=made[2]) == made[2]
    p.publish(numbers(spark, 4), "t", database, keep=1)
    assert len(p.versions(spark, "t", database)) == 1


def test_versions_of_similar_names_are_apart(spark, database):
    for name in ("t", "t__v000001_0a0a0a0a_x", "t_2", "T2"):
        overwrite_table(numbers(spark, 2), name, database)
    assert len(p.versions(spark, "t", database)) == 1
    drop_table(spark, "t", database)
    assert not spark.catalog.tableExists(f"{database}.t") and p.versions(spark, "t", database) == []
    assert spark.table(f"{database}.t2").count() == 2


def test_plain_table_of_an_earlier_release(spark, database):
    numbers(spark, 3).write.partitionBy("k").saveAsTable(f"{database}.t")
    with pytest.raises(Exception, match="no such row"):
        overwrite_partitioned(failing(spark), "t", "k", database)
    assert spark.table(f"{database}.t").count() == 3
    overwrite_partitioned(numbers(spark, 5).withColumn("new", F.lit("x")), "t", "k", database)
    assert p.is_view(spark, "t", database) and spark.table(f"{database}.t").count() == 5
    drop_table(spark, "t", database)
    spark.range(2).write.saveAsTable(f"{database}.t")
    drop_table(spark, "t", database)
    assert not spark.catalog.tableExists(f"{database}.t")


def test_empty_frame(spark, database):
    overwrite_table(spark.createDataFrame([], "id bigint, k int"), "t", database)
    overwrite_partitioned(spark.createDataFrame([], "id bigint, k int"), "u", "k", database)
    assert spark.table(f"{database}.t").count() == spark.table(f"{database}.u").count() == 0


def test_failed_gold_build_keeps_the_gold_tables(spark, database, monkeypatch):
    batch.run_batch(spark, catalog.source_paths(catalog.source_files(spark, SF_DIR)), database)
    tables = ["gold_orders", "gold_profit_agg", "silver_customer"]
    before = {t: sorted(map(str, spark.table(f"{database}.{t}").collect())) for t in tables}
    real = batch.profit_agg

    def broken(lines):
        return real(lines).withColumn("Profit", F.raise_error(F.lit("no profit")).cast("double"))

    monkeypatch.setattr(batch, "profit_agg", broken)
    with pytest.raises(Exception, match="no profit"):
        batch.build_gold(spark, database)
    assert {t: sorted(map(str, spark.table(f"{database}.{t}").collect())) for t in tables} == before
