import os

import pytest

from presslake.functions.keys import FINAL_PREFIX, PROCESSED_PREFIX
from presslake.operators.extract import extract_headlines
from presslake.operators.rules import BLOCK_CARDS
from presslake.plans.headlines import publish_final
from presslake.sources.page_stream import PageFileReader
from presslake.sources.pages import scan_pages
from presslake.sources.tables import scan_headline_csv
from presslake.streaming.headlines import stream_final, stream_processed
from tests.test_tables import AS_OF, CARD, write_file

BLOCK = '<div class="BlockContainer-Content"><h2 class="Card-Title">{}</h2></div>'


def run(start, spark, root, checkpoint, **options):
    start(spark, str(root), str(checkpoint), once=True, **options).awaitTermination()


def test_stream_equals_batch_and_a_rerun_adds_nothing(spark, tmp_path):
    root, checkpoint = tmp_path / "lake", tmp_path / "checkpoint"
    for name in "abc":
        write_file(root, f"headlines/raw/{name}.html", BLOCK.format(name) * 2)
    write_file(root, "headlines/raw/bad.html", b"\xff")

    def streamed():
        return sorted(map(tuple, scan_headline_csv(spark, f"{root}/{PROCESSED_PREFIX}").collect()))

    run(stream_processed, spark, root, checkpoint, max_files_per_trigger=2)
    batch = extract_headlines(scan_pages(spark, str(root)), BLOCK_CARDS)
    expected = sorted(map(tuple, batch.select("category", "title", "description").collect()))
    assert len(expected) == 6
    assert streamed() == expected
    run(stream_processed, spark, root, checkpoint)
    assert streamed() == expected
    write_file(root, "headlines/raw/d.html", BLOCK.format("d"))
    run(stream_processed, spark, root, checkpoint)
    assert len(streamed()) == 7


def test_stream_to_the_final_table(spark, tmp_path):
    root = tmp_path / "lake"
    write_file(root, "headlines/raw/eltiempo/2025-05-06/a.html", CARD.format("a"))
    write_file(root, "headlines/raw/eltiempo/2025-05-06-1/b.html", CARD.format("b"))
    run(stream_final, spark, root, tmp_path / "checkpoint", as_of=AS_OF)
    rows = (
        spark.read.options(header=True, sep=";", escape='"')
        .schema("categoria string, titular string, enlace string, fecha_extraccion string, "
                "periodico string, year string, month string, day string")
        .csv(f"{root}/{FINAL_PREFIX}").collect()
    )
    assert [tuple(row) for row in rows] == [
        ("N/A", "a", "https://www.eltiempo.com/a", AS_OF, "eltiempo", "2025", "05", "06")
    ]


def final_rows(spark, root):
    schema = "categoria string, titular string, enlace string, fecha_extraccion string"
    schema += ", periodico string, year string, month string, day string"
    rows = spark.read.options(header=True, sep=";", escape='"').schema(schema).csv(f"{root}/{FINAL_PREFIX}")
    return sorted((r.titular, r.day) for r in rows.collect())


def test_the_last_writer_of_a_stream_outlives_restarts(spark, tmp_path):
    root, checkpoint = tmp_path / "lake", tmp_path / "checkpoint"
    last = {"as_of": AS_OF, "on_collision": "last"}
    for name in "bc":
        write_file(root, f"headlines/raw/eltiempo/2025-05-06/{name}.html", CARD.format(name))
    write_file(root, "headlines/raw/eltiempo/2025-05-07/a.html", CARD.format("other"))
    write_file(root, "headlines/raw/eltiempo/2025-05-06/z.html", "nothing")
    run(stream_final, spark, root, checkpoint, max_files_per_trigger=1, **last)
    assert final_rows(spark, root) == [("c", "06"), ("other", "07")]
    # Lesser keys come too late, in a query started anew.
    write_file(root, "headlines/raw/eltiempo/2025-05-06/a.html", CARD.format("a"))
    run(stream_final, spark, root, checkpoint, **last)
    assert final_rows(spark, root) == [("c", "06"), ("other", "07")]
    for name in "ed":
        write_file(root, f"headlines/raw/eltiempo/2025-05-06/{name}.html", CARD.format(name))
    run(stream_final, spark, root, checkpoint, **last)
    assert final_rows(spark, root) == [("e", "06"), ("other", "07")]
    publish_final(spark, str(root), as_of=AS_OF, on_collision="last")
    assert final_rows(spark, root) == [("e", "06"), ("other", "07")]


def test_unknown_ways_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="on_collision"):
        stream_final(spark, str(tmp_path), str(tmp_path / "c"), on_collision="first")


@pytest.mark.parametrize("last", [{}, {"on_collision": "last"}])
def test_a_page_written_again_is_read_again(spark, tmp_path, last):
    root, checkpoint = tmp_path / "lake", tmp_path / "checkpoint"
    options = {"as_of": AS_OF, "rewritten": True, "settle": 0, **last}
    for day in ("06", "07", "08"):
        write_file(root, f"headlines/raw/eltiempo/2025-05-{day}/a.html", CARD.format("old"))
    write_file(root, "headlines/raw/eltiempo/2025-05-06/empty.html", "")
    run(stream_final, spark, root, checkpoint, **options)
    assert final_rows(spark, root) == [("old", "06"), ("old", "07"), ("old", "08")]
    write_file(root, "headlines/raw/eltiempo/2025-05-07/a.html", CARD.format("new"))
    run(stream_final, spark, root, checkpoint, **options)
    assert final_rows(spark, root) == [("new", "07"), ("old", "06"), ("old", "08")]
    run(stream_final, spark, root, checkpoint, **options)
    assert final_rows(spark, root) == [("new", "07"), ("old", "06"), ("old", "08")]


def test_offsets_follow_time_and_path(tmp_path):
    for name, at in (("b", 5), ("a", 5), ("c", 3), ("d", 9)):
        write_file(tmp_path, f"{name}.html", name)
        os.utime(tmp_path / f"{name}.html", ns=(at, at))
    write_file(tmp_path, "young.html", "x")
    write_file(tmp_path, "other.txt", "x")
    reader = PageFileReader({"path": f"file:{tmp_path}", "settle": "3600"})
    start, middle, end = reader.initialOffset(), {"time": 5, "path": "a.html"}, {"time": 9, "path": "d.html"}
    assert reader.latestOffset() == end
    shares = reader.partitions(start, middle)
    assert [p for s in shares for p in s.paths] == ["c.html", "a.html"]
    assert [p.paths for p in reader.partitions(middle, end)] == [["b.html", "d.html"]]
    assert reader.partitions(end, end) == [] and reader.partitions(end, middle) == []
    os.remove(tmp_path / "a.html")
    assert [row[3] for row in reader.read(shares[0])] == [b"c"]
