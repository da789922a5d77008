"""JSON arrays read in parts, wherever a part begins."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslake.sources import json_arrays
from presslake.sources.json_arrays import Source, part_elements, part_summary, scan_json_array

VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.text('ab"\\[]{},: é漢\n', max_size=9),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text('k"\\,]', max_size=3), inner, max_size=3),
    max_leaves=9,
)


def elements(path, part):
    source, out, inside, depth = Source(path), [], False, 0
    for start in range(0, source.size, part):
        out += part_elements(source, start, start + part, inside, depth)
        n, outer, inner = part_summary(source, start, start + part)
        depth += inner if inside else outer
        inside ^= bool(n)
    return out


@settings(max_examples=150, deadline=None)
@given(values=st.lists(VALUES, max_size=7), part=st.integers(1, 40), spaced=st.booleans(), plain=st.booleans(), step=st.integers(1, 9))
def test_every_cut_gives_the_elements(tmp_path_factory, values, part, spaced, plain, step):
    json_arrays.STEP_BYTES, held = step, json_arrays.STEP_BYTES
    try:
        path = tmp_path_factory.mktemp("arrays") / "a.json"
        text = json.dumps(values, indent=1 if spaced else None, ensure_ascii=plain)
        path.write_text(f" {text}\n" if spaced else text, encoding="utf-8")
        assert [json.loads(e) for e in elements(f"file:{path}", part)] == values
    finally:
        json_arrays.STEP_BYTES = held


@pytest.mark.parametrize("part", [100, 7_000, 1 << 25])
def test_scan_of_several_files(spark, tmp_path, part):
    rows = [{"titular": f'{i} "x" \\ [', "enlace": None if i % 5 else f"/{i}", "categoria": "é"} for i in range(900)]
    (tmp_path / "a.json").write_text(json.dumps(rows[:600], ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(rows[600:], indent=2))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text("[ ]")
    schema = "titular string, enlace string, categoria string"
    from pyspark.sql import types as T

    found = scan_json_array(spark, str(tmp_path), T.StructType.fromDDL(schema), part).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        ((r["titular"], r["enlace"], r["categoria"]) for r in rows), key=repr
    )
