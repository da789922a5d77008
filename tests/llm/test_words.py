import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from presslake.llm.words import blocks, shingle_hashes, word_hashes

TEXT = st.one_of(st.none(), st.text(alphabet="aAbé 漢\n\t\r.", max_size=30))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8))
def test_words_and_shingles_agree_with_plain_ones(texts):
    words, rows = word_hashes(pa.array(texts, pa.string()), lower=False)
    plain = [plain_words(text) for text in texts]
    assert np.diff(rows).tolist() == [len(w) for w in plain]
    flat = [w for some in plain for w in some]
    assert len(set(zip(flat, words.tolist()))) == len(set(flat)) == len(set(words.tolist()))
    hashes, starts = shingle_hashes(words, rows, 3)
    sets = [
        [tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([tuple(w)] if w else [])
        for w in plain
    ]
    assert np.diff(starts).tolist() == [len(s) for s in sets]
    flat = [s for some in sets for s in some]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_only_a_to_z_are_folded():
    same, _ = word_hashes(pa.array(["ABC abc", "É é"]))
    assert same[0] == same[1] and same[2] != same[3]


def test_sliced_arrays_keep_their_rows():
    column = pa.array(["a b", None, "c", "d e f"])
    assert np.diff(word_hashes(column.slice(1, 3))[1]).tolist() == [0, 1, 3]


def test_blocks_cover_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10, None, "y" * 100, "", "z"])], ["t"])
    parts = list(blocks([batch], "t", 12))
    assert pa.Table.from_batches(parts).column("t").to_pylist() == batch.column(0).to_pylist()
    assert len(parts) > 1


def test_words_of_any_length_are_hashed_by_byte_and_place():
    from presslake.llm.words import _BYTE, _PLACE, SHORT, mix, span_hashes

    rng = np.random.default_rng(5)
    lengths = np.array([1, SHORT + 1, 3, SHORT, 9_000, 2, SHORT - 1, 40, 1])
    letters = rng.integers(0, 256, lengths.sum(), dtype=np.uint8)
    words = np.split(letters, np.cumsum(lengths)[:-1])
    sums = [(_BYTE[own] * _PLACE[np.arange(len(own)) & 4095]).sum() + np.uint64(len(own)) for own in words]
    assert span_hashes(letters, lengths).tolist() == mix(np.array(sums)).tolist()
    assert not len(span_hashes(letters[:0], lengths[:0]))


def test_a_task_gives_memory_back_when_it_has_ended(monkeypatch):
    from presslake.llm import words

    released = []
    monkeypatch.setattr(words, "release", lambda: released.append(len(held)))
    held: list[int] = []
    for x in words.tidy(lambda batches: (2 * x for x in batches))([1, 2, 3]):
        held.append(x)
        assert not released
    assert (held, released) == ([2, 4, 6], [3])


def test_freed_memory_goes_back_to_the_system():
    from presslake.llm.words import release

    def held() -> int:
        return int(open("/proc/self/statm").read().split()[1]) * 4_096

    apart, freed = [], []
    for _ in range(3_000):  # what stays lies between what is freed
        freed.append(np.ones(2_000))
        apart.append(np.ones(1))
    before = held()
    del freed
    release()
    assert before - held() > 20 << 20
