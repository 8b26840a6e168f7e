"""Files loaded once: outcomes by file, interrupted loads, files delivered again."""

import gzip
import json
import os
from collections import Counter

import pytest

from tallyforge.plans.batch import build_gold, build_silver, run_batch
from tallyforge.schemas import CUSTOMERS, ORDERS_FILE
from tallyforge.sinks.publish import property_of
from tallyforge.sources import ledger as led
from tallyforge.sources.ledger import Source, ingest_new_files, ledger, write_apart

ORDER = dict.fromkeys(ORDERS_FILE, None)


def orders(*ids):
    return [ORDER | {"Row ID": i, "Order Date": "1/2/2017", "Customer ID": "C1", "Product ID": "P1", "Profit": 1.5} for i in ids]


def put(folder, name, rows, form="lines", cut=None):
    text = json.dumps(rows, indent=1) if form == "whole" else "\n".join(map(json.dumps, rows))
    data = text.encode()
    data = gzip.compress(data) if name.endswith(".gz") else data
    path = folder / name
    path.write_bytes(data[:cut] if cut else data)
    stamp = put.clock = getattr(put, "clock", 1_700_000_000) + 10
    os.utime(path, (stamp, stamp))


def row_ids(spark, database):
    return sorted(r.Row_ID for r in spark.table(f"{database}.bronze_orders").collect())


def outcomes(manifest):
    return {(r.path or "").rsplit("/", 1)[-1]: (r.status, r.row_count, r.corrupt_rows) for r in manifest.collect()}


def test_two_loads_with_a_truncated_file(spark, tmp_path, database):
    folder = tmp_path / "Orders of {May}"
    folder.mkdir()
    put(folder, "a.json", orders(1, 2))
    put(folder, "b.json", orders(3, 4, 5), "whole")
    put(folder, "c.json.gz", orders(*range(6, 2000)), cut=3000)
    put(folder, "d é+.json.gz", orders(6))
    put(folder, "e.json", orders(7, 8) + ["x"])
    (folder / "f.json").write_text("Row ID;Price\n1;2\n")
    (folder / "g.xlsx").write_text("x")
    (folder / "h.json").write_text("\n")
    first = outcomes(ingest_new_files(spark, [str(tmp_path / "Orders of*")], database))
    assert first == {
        "a.json": ("loaded", 2, 0), "b.json": ("loaded", 3, 0), "c.json.gz": ("error", None, None), "d é+.json.gz": ("loaded", 1, 0),
        "e.json": ("loaded", 3, 1), "f.json": ("error", None, None), "g.xlsx": ("error", None, None), "h.json": ("loaded", 0, 0),
    }
    assert [i for i in row_ids_or_null(spark, database) if i is not None] == [1, 2, 3, 4, 5, 6, 7, 8]
    errors = {r.path.rsplit("/", 1)[1]: r.error for r in ledger(spark, "bronze_orders", database).filter("status = 'error'").collect()}
    assert "c.json.gz" in errors["c.json.gz"] and "neither" in errors["f.json"] and "unknown ending xlsx" in errors["g.xlsx"]
    # Nothing new: only what failed is tried again.
    again = outcomes(ingest_new_files(spark, [str(tmp_path / "Orders of*")], database))
    assert again == {n: o for n, o in first.items() if o[0] == "error"}
    put(folder, "c.json.gz", orders(9))
    put(folder, "i.json", orders(10))
    found = outcomes(ingest_new_files(spark, [str(tmp_path / "Orders of*")], database))
    assert {n: o for n, o in found.items() if o[0] == "loaded"} == {"c.json.gz": ("loaded", 1, 0), "i.json": ("loaded", 1, 0)}
    assert [i for i in row_ids_or_null(spark, database) if i is not None] == list(range(1, 11))


def row_ids_or_null(spark, database):
    found = [r.Row_ID for r in spark.table(f"{database}.bronze_orders").collect()]
    return sorted(found, key=lambda i: (i is None, i))


def test_nothing_new_changes_nothing(spark, tmp_path, database):
    put(tmp_path, "Orders.json", orders(1, 1, 2))
    ingest_new_files(spark, [str(tmp_path)], database)
    state = property_of(spark, "bronze_orders", "load", database)
    assert ingest_new_files(spark, [str(tmp_path)], database).collect() == []
    assert property_of(spark, "bronze_orders", "load", database) == state == "1"
    assert row_ids(spark, database) == [1, 1, 2]


def test_a_file_delivered_again_replaces_its_rows(spark, tmp_path, database):
    put(tmp_path, "Orders_a.json", orders(1, 2))
    put(tmp_path, "Orders_b.json", orders(3))
    ingest_new_files(spark, [str(tmp_path)], database)
    put(tmp_path, "Orders_c.json", orders(4))
    ingest_new_files(spark, [str(tmp_path)], database)
    first = (tmp_path / "Orders_a.json").stat()
    put(tmp_path, "Orders_a.json", orders(2, 5, 6))
    put(tmp_path, "Orders_d.json", orders(7))
    found = outcomes(ingest_new_files(spark, [str(tmp_path)], database))
    assert found == {"Orders_a.json": ("loaded", 3, 0), "Orders_d.json": ("loaded", 1, 0)}
    assert row_ids(spark, database) == [2, 3, 4, 5, 6, 7]
    assert property_of(spark, "bronze_orders", "replaced", database) == "1"
    # A damaged one does not.
    put(tmp_path, "Orders_c.json.gz", orders(*range(3000)), cut=2000)
    put(tmp_path, "Orders_d.json", [])
    (tmp_path / "Orders_d.json").write_text("Row ID;x")
    assert {o[0] for o in outcomes(ingest_new_files(spark, [str(tmp_path)], database)).values()} == {"error"}
    assert row_ids(spark, database) == [2, 3, 4, 5, 6, 7]
    # Back in its first state it is new again; files of the replaced load are not lost.
    put(tmp_path, "Orders_a.json", orders(1, 2))
    os.utime(tmp_path / "Orders_a.json", (first.st_atime, first.st_mtime))
    put(tmp_path, "Orders_b.json", orders(8))
    ingest_new_files(spark, [str(tmp_path)], database)
    assert row_ids(spark, database) == [1, 2, 4, 7, 8]


def test_an_interrupted_load_is_not_seen_and_done_again(spark, tmp_path, database, monkeypatch):
    put(tmp_path, "Orders_a.json", orders(1))
    ingest_new_files(spark, [str(tmp_path)], database)
    put(tmp_path, "Orders_b.json", orders(2))

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(led.Loads, "commit", lost)
        with pytest.raises(KeyboardInterrupt):
            ingest_new_files(spark, [str(tmp_path)], database)
    assert row_ids(spark, database) == [1] and ledger(spark, "bronze_orders", database).count() == 1
    put(tmp_path, "Orders_c.json", orders(3))
    assert len(outcomes(ingest_new_files(spark, [str(tmp_path)], database))) == 2
    assert row_ids(spark, database) == [1, 2, 3]


def test_few_files_at_once(spark, tmp_path, database):
    for i in range(7):
        put(tmp_path, f"Orders_{i}.json", orders(i), "whole" if i % 2 else "lines")
    assert len(outcomes(ingest_new_files(spark, [str(tmp_path)], database, files_at_once=2))) == 7
    assert row_ids(spark, database) == list(range(7))


def test_a_truncated_file_is_not_written_with_others(spark, tmp_path, database, monkeypatch):
    put(tmp_path, "Orders_a.json", orders(1))
    put(tmp_path, "Orders_b.json.gz", orders(2))
    put(tmp_path, "Orders_c.json.gz", orders(*range(3, 2000)), cut=3000)
    put(tmp_path, "Orders_d.json.gz", orders(2000))
    groups, apart = [], led.write_apart
    monkeypatch.setattr(led, "write_apart", lambda files, write: apart(files, lambda g: (groups.append(names(g)), write(g))))
    assert outcomes(ingest_new_files(spark, [str(tmp_path)], database))["Orders_c.json.gz"][0] == "error"
    assert groups == [["Orders_a.json", "Orders_b.json.gz", "Orders_d.json.gz"], ["Orders_c.json.gz"]]
    assert row_ids(spark, database) == [1, 2, 2000]


def names(files):
    return [f.path.rsplit("/", 1)[-1] for f in files]


@pytest.mark.parametrize("named", [True, False])
def test_bad_files_are_found(named):
    files = [Source(f"/in/f{i:03d}.json", 1, None, "lines") for i in range(300)]
    bad = {files[i] for i in (0, 7, 8, 150, 299)}
    wrote, written = Counter(), 0

    def write(group):
        nonlocal written
        written += len(group)
        wrong = [f for f in group if f in bad]
        if wrong:
            raise OSError(f"could not read {wrong[0].path}" if named else "could not read")
        wrote.update(group)

    found = {f for f, _ in write_apart(files, write)}
    assert found == bad and wrote == Counter(f for f in files if f not in bad)
    assert written < 4 * len(files)
    assert list(write_apart(files[1:7], write)) == []


def test_all_kinds_and_unknown_paths(spark, tmp_path, database):
    put(tmp_path, "Orders.json", orders(1, 2))
    (tmp_path / "Products.csv").write_text("a,b,c,d\nP1,Tech,Phones,N\nP2,C\n")
    customer = "C1,Ann Lee,e,555,1 St,s,c,t,st,1,r"
    (tmp_path / "Customer_1.csv").write_text(",".join(CUSTOMERS) + f"\n{customer}\n")
    more = spark.createDataFrame([customer.replace("C1", "C2").split(",")], list(CUSTOMERS))
    more.coalesce(1).write.parquet(str(tmp_path / "Customer_2"))
    (tmp_path / "Customer_3.parquet").write_bytes(b"not a table")
    (tmp_path / "Returns.csv").write_text("x\n")
    manifest = ingest_new_files(spark, [str(tmp_path), str(tmp_path / "Orders*"), str(tmp_path / "none.csv")], database)
    rows = manifest.collect()
    assert Counter((r.table_name, r.status, r.row_count, r.corrupt_rows) for r in rows) == Counter(
        [("bronze_orders", "loaded", 2, 0), ("bronze_products", "loaded", 2, 1), ("bronze_customer", "loaded", 1, 0),
         ("bronze_customer", "loaded", 1, 0), ("bronze_customer", "error", None, None), (None, "error", None, None), (None, "error", None, None)]
    )
    assert {r.error[:16] for r in rows if r.table_name is None} == {"unknown kind of ", "[PATH_NOT_FOUND]"}
    build_silver(spark, database)
    build_gold(spark, database)
    assert sorted(r.Row_ID for r in spark.table(f"{database}.gold_orders").collect()) == [1, 2]


def test_batch_of_new_files(spark, tmp_path, database):
    put(tmp_path, "Orders_1.json", orders(1, 2))
    (tmp_path / "Products.csv").write_text("a,b,c,d\nP1,Tech,Phones,N\n")
    (tmp_path / "Customer.csv").write_text(",".join(CUSTOMERS) + "\nC1,Ann Lee,e,555,1 St,s,c,t,st,1,r\n")
    assert run_batch(spark, [str(tmp_path)], database, new_files_only=True).count() == 3
    put(tmp_path, "Orders_2.json", orders(3))
    assert run_batch(spark, [str(tmp_path)], database, new_files_only=True).count() == 1
    assert sorted(r.Row_ID for r in spark.table(f"{database}.gold_orders").collect()) == [1, 2, 3]
    # A plain load takes the table over, and new loads begin afresh.
    run_batch(spark, [str(tmp_path / n) for n in ("Orders_1.json", "Products.csv", "Customer.csv")], database)
    assert row_ids(spark, database) == [1, 2]
    ingest_new_files(spark, [str(tmp_path)], database)
    assert row_ids(spark, database) == [1, 2, 3]
