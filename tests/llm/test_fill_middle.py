import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphtide.llm.fill_middle import Units, WaveletMatrix, fill_in_middle, restored

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
TEXTS = st.lists(st.text(alphabet=" \t\n\x0bab7.é <P>", max_size=30) | st.none(), min_size=1, max_size=6)


def plain_result(doc_id, text):
    """The contract, straight from its words."""
    text, digest = text or "", hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=200))
def test_ranks_are_counts(symbols):
    array = np.array(symbols, np.uint8)
    matrix = WaveletMatrix(array, 3)
    places = np.arange(len(array) + 1)
    for symbol in range(8):
        assert matrix.rank(symbol, places).tolist() == [symbols[:i].count(symbol) for i in places]


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(0, 40))
def test_cuts_fall_after_whole_units(texts, wanted):
    units = Units(pa.array(texts, pa.string()))
    whole = [UNIT.findall(t or "") for t in texts]
    assert units.count.tolist() == [len(w) for w in whole]
    asked = np.minimum(wanted, units.count)
    assert units.cut(asked).tolist() == [sum(map(len, w[:k])) for w, k in zip(whole, asked.tolist())]


def test_agrees_with_the_plain_method(spark, documents):
    texts = [None, "", " ", "\n\t", "one", " one  two\n", "has <P> in it", "a<", "P>b <", "é ü x 𝄞 y", "w " * 60_000 + "end", "same text here", "same text here"]
    rows = [(10 * k + i, t) for k in range(40) for i, t in enumerate(texts) if t is None or len(t) < 1000 or k == 3]
    docs = documents([*rows, rows[5]]).withColumn("FORM", F.lit("own"))
    done = fill_in_middle(docs, keep=["doc_id", "text", "score", "FORM"])
    assert done.columns == ["doc_id", "text", "score", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = done.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows) + 1 and {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_result(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_null_ids_and_empty_tables(documents):
    assert fill_in_middle(documents([(None, "a b c")])).collect()[0].n == 3
    assert fill_in_middle(documents([(1, "a")]).where("false")).count() == 0
