"""Every query of the subpackage on a small test table, against its SQL where there is one."""

import os

import duckdb
import pytest

from tallyforge.llm.oracle import all_oracles
from tallyforge.llm.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, name):
    found = all_queries()[name](spark, SF_DIR)
    rows = found.collect()
    assert rows
    if name not in all_oracles():
        return
    with duckdb.connect() as db:
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        cursor = db.execute(all_oracles()[name])
        names = [d[0] for d in cursor.description]
        expected = [dict(zip(names, r)) for r in cursor.fetchall()]
    assert sorted(names) == sorted(found.columns)
    order = sorted(names)
    assert sorted(str([r[k] for k in order]) for r in rows) == sorted(str([r[k] for k in order]) for r in expected)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in all_queries()) == list(range(1, 14))
