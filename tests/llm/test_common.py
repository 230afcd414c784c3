import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from graphtide.llm.common import Words, code_points, pieces, utf8

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 .\n@éД語\U0001f600\0", max_size=30)), max_size=8)


def words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@given(TEXTS, st.integers(0, 2))
@settings(max_examples=80, deadline=None)
def test_words_of_sliced_batches(texts, skip):
    doc = Words(pa.array(["zz", *texts], pa.string()).slice(1).slice(min(skip, len(texts))))
    hashes = doc.hashes()
    seen = {}
    for row, text in enumerate(texts[min(skip, len(texts)):]):
        a, b = doc.first[row], doc.first[row + 1]
        assert [doc.text(i, i + 1).decode() for i in range(a, b)] == words(text)
        for i in range(a, b):
            assert seen.setdefault(doc.text(i, i + 1), hashes[i]) == hashes[i]
    assert len(set(seen.values())) == len(seen)


@given(TEXTS)
@settings(max_examples=50, deadline=None)
def test_code_points(texts):
    points, first = code_points(pa.array(texts, pa.string()))
    assert ["".join(map(chr, points[a:b])) for a, b in zip(first, first[1:])] == [t or "" for t in texts]


def test_bytes_that_are_not_utf8_keep_their_text():
    raw = pa.array([b"a\xff\xffb", b"cd"], pa.binary())
    broken = pa.Array.from_buffers(pa.string(), 2, raw.buffers())
    points, first = code_points(broken)
    assert "".join(map(chr, points[first[1]:first[2]])) == "cd"


def test_pieces_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 7, None, "b" * 50, "", "c"])], names=["t"])
    out = list(pieces(iter([batch, batch.slice(0, 0)]), 0, limit=10))
    assert sum((p.column(0).to_pylist() for p in out), []) == batch.column(0).to_pylist()
    assert len(out) > 1


def test_empty_array():
    data, offsets = utf8(pa.array([], pa.string()))
    assert len(data) == 0 and offsets.tolist() == [0]
    assert np.all(Words(pa.array([None, ""], pa.string())).count == 0)
