"""Page files in few large ones, and partitions registered by the run that wrote them."""

import glob

import pytest

from presslake.operators import compaction
from presslake.operators.catalog import list_partitions, partition_places, register_written
from presslake.operators.compaction import GENERATIONS, compact_final, packed_files
from presslake.plans.headlines import publish_final
from presslake.sources.tables import scan_final
from tests.test_tables import AS_OF, CARD, write_file


@pytest.fixture
def lake(spark, tmp_path):
    """A table of three days with several pages each; its name and root."""
    name = "compacted_" + "".join(c for c in tmp_path.name if c.isalnum())
    for day, n in (("06", 5), ("07", 3), ("08", 1)):
        for i in range(n):
            write_file(tmp_path, f"headlines/raw/eltiempo/2025-05-{day}/p{i}.html", CARD.format(f'"q" {day}{i}') * 2)
    publish_final(spark, str(tmp_path), as_of=AS_OF, table=name)
    yield name, tmp_path
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows_of(spark, name):
    return sorted((r.titular, r.day) for r in scan_final(spark, name).collect())


def files_read(spark, name, day):
    return sorted(scan_final(spark, name, day=day).inputFiles())


def test_rows_stay_and_files_are_few(spark, lake):
    name, root = lake
    before = rows_of(spark, name)
    assert len(before) == 18 and len(files_read(spark, name, "06")) == 5
    done = {r.folder[-7:-1]: (r.n_files, r.n_large) for r in compact_final(spark, str(root), name).collect()}
    assert done == {"day=06": (5, 1), "day=07": (3, 1)}
    assert rows_of(spark, name) == before
    assert [len(files_read(spark, name, d)) for d in ("06", "07", "08")] == [1, 1, 1]
    assert GENERATIONS in files_read(spark, name, "06")[0] and GENERATIONS not in files_read(spark, name, "08")[0]
    # A rerun changes nothing.
    written = sorted(glob.glob(f"{root}/{GENERATIONS}/**/*.csv", recursive=True))
    assert compact_final(spark, str(root), name).isEmpty()
    assert sorted(glob.glob(f"{root}/{GENERATIONS}/**/*.csv", recursive=True)) == written


def test_files_are_bounded_by_bytes(spark, lake):
    name, root = lake
    before = rows_of(spark, name)
    size = len(open(glob.glob(f"{root}/headlines/final/**/day=06/*.csv", recursive=True)[0]).read())
    compact_final(spark, str(root), name, target_bytes=2 * size)
    assert rows_of(spark, name) == before and len(files_read(spark, name, "06")) == 3


def test_publishing_shows_new_rows_and_keeps_the_rest(spark, lake):
    name, root = lake
    before = rows_of(spark, name)
    compact_final(spark, str(root), name)
    write_file(root, "headlines/raw/eltiempo/2025-05-06/p1.html", CARD.format("new"))
    pages = "headlines/raw/eltiempo/2025-05-06/"
    publish_final(spark, str(root), as_of=AS_OF, table=name, prefix=pages)
    after = rows_of(spark, name)
    assert len(after) == 17 and ("new", "06") in after and len(set(before) - set(after)) == 1
    assert GENERATIONS in files_read(spark, name, "07")[0]
    assert [r.n_files for r in compact_final(spark, str(root), name).collect()] == [5]
    assert rows_of(spark, name) == after and len(files_read(spark, name, "06")) == 1


def test_a_page_published_meanwhile_is_not_lost(spark, lake, monkeypatch):
    name, root = lake

    def slow(*args):
        stored(*args)
        write_file(root, "headlines/raw/eltiempo/2025-05-07/late.html", CARD.format("late"))
        publish_final(spark, str(root), as_of=AS_OF, table=name, prefix="headlines/raw/eltiempo/2025-05-07/")

    stored = compaction.store_objects
    monkeypatch.setattr(compaction, "store_objects", slow)
    done = [r.folder[-7:-1] for r in compact_final(spark, str(root), name).collect()]
    assert done == ["day=06"] and ("late", "07") in rows_of(spark, name) and len(rows_of(spark, name)) == 19


def test_a_failed_run_leaves_the_table_as_it_was(spark, lake, monkeypatch):
    name, root = lake
    before, places = rows_of(spark, name), partition_places(spark, name)

    def broken(*args):
        raise OSError("disk")

    monkeypatch.setattr(compaction, "store_objects", broken)
    with pytest.raises(OSError):
        compact_final(spark, str(root), name)
    assert rows_of(spark, name) == before and partition_places(spark, name) == places


def test_bins_follow_names_and_sizes(spark):
    sizes = [40, 40, 40, 500, 10, 10, 90]
    rows = [("f", f"n{i}", size, 0) for i, size in enumerate(sizes)] + [("g", "a", 1, 0)]
    files = spark.createDataFrame(rows, "folder string, name string, size bigint, time bigint")
    found = {(r.folder, r.name): r.bin for r in packed_files(files, 100).collect()}
    assert [found["f", f"n{i}"] for i in range(7)] == [0, 0, 0, 1, 2, 2, 2] and found["g", "a"] == 0


def test_runs_register_what_they_wrote(spark, lake, monkeypatch):
    name, root = lake
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or sql(self, text, *a, **k))
    write_file(root, "headlines/raw/eltiempo/2025-05-09/x.html", CARD.format("x"))
    publish_final(spark, str(root), as_of=AS_OF, table=name, prefix="headlines/raw/eltiempo/2025-05-09/")
    assert not any("MSCK" in text for text in said) and sum("ADD IF NOT EXISTS" in text for text in said) == 1
    assert list_partitions(spark, name).count() == 4 and ("x", "09") in rows_of(spark, name)
    odd = {("el'x", "2025", "05", f"{d:02d}"): f"{root}/odd/{d}" for d in range(1, 6)}
    register_written(spark, name, odd)
    register_written(spark, name, odd)
    assert list_partitions(spark, name).count() == 9
    assert set(odd) <= set(partition_places(spark, name))
    assert partition_places(spark, name, [("no", "2025", "01", "01")]) == {}
