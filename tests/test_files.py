"""Many small files, listed and read by tasks."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presslake.functions.keys import FINAL_PREFIX
from presslake.schemas import FINAL_HEADLINE, FINAL_PARTITIONS
from presslake.sources import files as files_module
from presslake.sources import tables
from presslake.sources.files import dealt, find_folders, list_files, read_files, with_contents
from presslake.sources.tables import CSV_DIALECT, csv_records, scan_final_files, scan_headline_csv
from tests.test_tables import write_file

TEXTS = [
    'a', '', '""', '"a;b",c', 'x\ry', '"x\ny"', '"say ""hi"""', 'a"b', '"a"b', ' a ', '"\r\n"', 'ñ ",', '"""\n;"""', "\0", "#x",
]


def tree(root):
    for name in ("a.html", "s/1/b.html", "s/1/c.txt", "s/1/_x.html", "s/.h/d.html", "s/_t/e.html", "s/2/p=_/f.html"):
        write_file(root, name, name)
    write_file(root, "s/2/empty.html", "")


@pytest.mark.parametrize("wanted", [1, 2, 100])
def test_files_are_found_in_folders_and_below(spark, tmp_path, monkeypatch, wanted):
    tree(tmp_path)
    monkeypatch.setattr(files_module, "FOLDERS", wanted)
    monkeypatch.setattr(find_folders, "__defaults__", (wanted,))
    root = f"file:{tmp_path}"
    found = list_files(spark, root, ".html")
    by_spark = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.html").load(root)
    kept = {row.path: bytes(row.content) for row in by_spark.collect() if row.length}
    assert {row.path for row in found.collect()} == set(kept) and len(kept) == 3
    assert {row.path: bytes(row.content) for row in with_contents(dealt(found), root).collect()} == kept
    assert list_files(spark, f"{root}/none").isEmpty()


def test_files_are_read_in_arrays_of_bounded_size(tmp_path, monkeypatch):
    for i in range(9):
        write_file(tmp_path, f"{i}", str(i) * 10)
    monkeypatch.setattr(files_module, "BATCH_BYTES", 25)
    root = f"file:{tmp_path}"
    read = list(read_files(root, [pa.array([f"{root}/{i}" for i in range(9)])]))
    assert [len(some) for some in read] == [3, 3, 3]
    assert [data for some in read for data in some.to_pylist()] == [str(i).encode() * 10 for i in range(9)]


def test_a_filter_on_paths_comes_before_the_reading(spark, tmp_path):
    write_file(tmp_path, "a.html", "a")
    write_file(tmp_path, "b.html", "b")
    root = f"file:{tmp_path}"
    files = with_contents(dealt(list_files(spark, root)), root).filter(F.col("path").endswith("a.html"))
    os.remove(tmp_path / "b.html")  # read, it would be an error
    assert [bytes(row.content) for row in files.collect()] == [b"a"]


@pytest.mark.parametrize("small", [tables.SMALL_BYTES, 60])
def test_small_files_are_parsed_as_by_spark(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(tables, "SMALL_BYTES", small)
    for i, end in enumerate(("\n", "\r\n")):
        lines = ["category,title,description", *[f"c,{text},{j}" for j, text in enumerate(TEXTS)], "", "few", "a,b,c,many"]
        write_file(tmp_path, f"p/{i}/x.csv", end.join(lines).encode())
    write_file(tmp_path, "p/y.csv", "category,title,description")
    write_file(tmp_path, "p/_SUCCESS", "no table")
    for schema in ({"schema": None}, {}):
        found = scan_headline_csv(spark, f"{tmp_path}/p", recursive=True, **schema)
        by_spark = spark.read.schema(found.schema).options(**CSV_DIALECT, recursiveFileLookup=True).csv(f"{tmp_path}/p")
        assert found.columns == ["category", "title", "description"]
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, by_spark.collect()), key=repr)
        write_file(tmp_path, "p/{y},[z].csv", "category,title,description\n" + "d,e,f\n" * 20)
    write_file(tmp_path, "p/z.csv", "other,title,description\na,b,c\n")
    with pytest.raises(Exception, match="header"):
        scan_headline_csv(spark, f"{tmp_path}/p", recursive=True).collect()


@pytest.mark.parametrize("small", [tables.SMALL_BYTES, 1])
def test_final_files_have_the_values_of_their_folders(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(tables, "SMALL_BYTES", small)
    folder = f"{FINAL_PREFIX}periodico=a%3Ab/year=2025/month=05/day=__HIVE_DEFAULT_PARTITION__"
    write_file(tmp_path, f"{folder}/x.csv", "categoria;titular;enlace;fecha_extraccion\n\"\";\"a\nb\";;d\n")
    found = scan_final_files(spark, f"{tmp_path}/{FINAL_PREFIX}")
    assert found.columns == [*FINAL_HEADLINE.names, *FINAL_PARTITIONS]
    columns = ", ".join(f"{name} string" for name in found.columns)
    dialect = {"header": True, "sep": ";", "escape": '"', "multiLine": True}
    by_spark = spark.read.schema(columns).options(**dialect).csv(f"{tmp_path}/{FINAL_PREFIX}")
    assert [tuple(row) for row in found.collect()] == [tuple(row) for row in by_spark.collect()]
    assert found.first().periodico == "a:b"


def test_records_end_where_their_quotes_do():
    assert list(csv_records('a,"b\n""c""",d\n\n"x\n"\n')) == ['a,"b\n""c""",d', '"x\n"']
    assert list(csv_records('a,"\r\n"\r\nb,"c"\r\n')) == ['a,"\n"', 'b,"c"']
    assert list(csv_records("")) == []


def test_the_driver_holds_no_path(spark, tmp_path, monkeypatch):
    """Scans list nothing on the driver but folders; Spark's file index would have all files."""
    for i in range(40):
        write_file(tmp_path, f"p/{i % 2}/{i}.csv", "category,title,description\nc,t,d\n")
    rows = scan_headline_csv(spark, f"{tmp_path}/p", recursive=True)
    assert rows.count() == 40
    assert all("/p/" not in path for path in rows.inputFiles())
    monkeypatch.setattr(tables, "holds", lambda root: False)
    assert len(scan_headline_csv(spark, f"{tmp_path}/p", recursive=True).inputFiles()) == 40
