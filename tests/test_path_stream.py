"""Pages as they arrive: their paths are listed by tasks, and taken in once."""

import os

from presslake.sources.pages import scan_pages, stream_pages
from presslake.sources.path_stream import PathReader
from tests.test_tables import write_file


def test_pages_are_not_listed_on_the_driver(spark, tmp_path):
    write_file(tmp_path, "headlines/raw/s/a.html", "a")
    assert all("/headlines/raw/" not in path for path in scan_pages(spark, str(tmp_path)).inputFiles())
    plan = stream_pages(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "presslake_paths" in plan and "binaryFile" not in plan


def test_the_offset_of_paths_changes_with_them(tmp_path):
    reader = PathReader({"path": f"file:{tmp_path}/raw"})
    assert reader.latestOffset() == reader.initialOffset()
    write_file(tmp_path, "raw/s/a.html", "a")
    write_file(tmp_path, "raw/s/empty.html", "")
    first = reader.latestOffset()
    assert first["paths"] == 1 and first == reader.latestOffset()
    os.rename(tmp_path / "raw/s/a.html", tmp_path / "raw/s/b.html")
    assert reader.latestOffset() != first
    paths = [path for folder in reader.partitions({}, {}) for b in reader.read(folder) for path in b.column(0).to_pylist()]
    assert paths == [f"file:{tmp_path}/raw/s/b.html"]
