"""The form of JSON a file holds, from its head."""

import gzip
import json
import random

import pytest

from tallyforge.sources import files, heads
from tallyforge.sources.files import read_orders_json

CASES = [
    ("", heads.EMPTY),
    ("\ufeff \n\t\r\n", heads.EMPTY),
    ("[]", heads.WHOLE),
    ("\ufeff\n [\n{}]", heads.WHOLE),
    ('[{"a": 1},\n{"a": 2}]', heads.WHOLE),
    ('[{"a": 1}]\n\n', heads.WHOLE),
    ('[{"a": 1}]\n[{"a": 2}]', heads.LINES),
    ('{"a": 1}', heads.LINES),
    ('{"a": 1}\n{"a": 2}\n', heads.LINES),
    (' {\n"a": 1}', heads.WHOLE),
    ("{ \r\n }", heads.WHOLE),
    ("{", heads.WHOLE),
    ("Row ID;Price\n1;2", heads.NEITHER),
    ("\x00", heads.NEITHER),
]


@pytest.mark.parametrize("text, form", CASES)
def test_forms_however_the_bytes_come(text, form):
    data = text.encode()
    for size in (1, 2, 3, 1 << 16):
        assert heads.form_of(data[i : i + size] for i in range(0, len(data), size)) == form


def test_no_more_is_read_than_the_first_line():
    def endless(start):
        yield start
        while True:
            read.append(1)
            assert len(read) < 4
            yield b"x" * 10

    for start in (b'{"a"', b"[\n", b"x", b"{\n"):
        read = []
        heads.form_of(endless(start))
        assert not read


def test_heads_and_scan_agree(spark, tmp_path):
    folder = tmp_path / "Orders of {May} é+%&, a#b"
    folder.mkdir()
    for i, (text, _) in enumerate(CASES):
        (folder / f"{i:02d} x.json").write_bytes(text.encode())
        with gzip.open(folder / f"{i:02d}.json.gz", "wb") as file:
            file.write(text.encode())
    path = str(tmp_path / "Orders of*")
    found = {r.path: r.form for r in heads.forms(heads.list_files(spark, path)).collect()}
    assert len(found) == 2 * len(CASES) - 1  # Spark lists no file of no bytes
    for name, form in found.items():
        assert form == CASES[int(name.rsplit("/", 1)[1][:2])][1], name
    scanned = {r.path: r.form for r in heads.forms_by_scan(spark, path).collect()}
    assert scanned == {n: f for n, f in found.items() if f != heads.EMPTY}


def test_files_that_cannot_be_opened_are_scanned(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text(json.dumps([{"Row ID": 1}]))
    (tmp_path / "b.json").write_text(json.dumps({"Row ID": 2}))
    listed = heads.list_files(spark, str(tmp_path)).select("path")
    odd = spark.createDataFrame([("nostore://x/a.json",), (f"file:{tmp_path}/none.json",)], "path string")
    assert {r.form for r in heads.forms(odd).collect()} == {heads.UNREAD}
    monkeypatch.setattr(files, "forms", lambda df: heads.forms(odd))
    counts, _ = files.order_forms(spark, str(tmp_path))
    assert counts == {heads.WHOLE: 1, heads.LINES: 1} and listed.count() == 2
    assert sorted(r["Row ID"] for r in read_orders_json(spark, str(tmp_path)).collect()) == [1, 2]


@pytest.mark.parametrize("arrays, lines", [(2, 7), (7, 2)])
def test_mixed_folder(spark, tmp_path, arrays, lines):
    ids = iter(random.Random(1).sample(range(1000), 200))
    wanted = []
    for i in range(arrays + lines):
        rows = [{"Row ID": next(ids)} for _ in range(5)]
        wanted += [r["Row ID"] for r in rows]
        text = json.dumps(rows, indent=1) if i < arrays else "\n".join(map(json.dumps, rows))
        (tmp_path / f"Orders {i}+.json").write_text(text)
    df = read_orders_json(spark, str(tmp_path))
    assert sorted(r["Row ID"] for r in df.collect()) == sorted(wanted)


def test_files_of_the_other_form_are_not_opened(spark, tmp_path):
    whole = gzip.compress(b"[\n" + b",\n".join(json.dumps({"Row ID": i, "Order ID": "x" * (i % 97)}).encode() for i in range(5000)) + b"\n]")
    (tmp_path / "a.json.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "b.json").write_text(json.dumps({"Row ID": 2}))
    (tmp_path / "c.json").write_text(json.dumps({"Row ID": 3}))
    name = str(tmp_path / "a.json.gz")
    rows = spark.read.schema("`Row ID` bigint").json(str(tmp_path))
    assert sorted(r["Row ID"] for r in rows.filter(~heads.file_of_row().isin([f"file:{name}"])).collect()) == [2, 3]
    with pytest.raises(Exception, match="a.json.gz"):
        rows.collect()
