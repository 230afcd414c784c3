import hashlib
import random
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from graphtide.llm.queries import op12_runs
from graphtide.llm.runs import collapse_runs, find_runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(w, least_words=24, least_periods=3):
    """All runs by trying each period at each place."""
    found = {}
    for q in range(1, len(w) // least_periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least_words, least_periods * q):
                found.setdefault((i, j + q), q)  # the smallest period of these words
            i = max(j, i + 1)
    return sorted((a, b, q) for (a, b), q in found.items())


def plain_row(words):
    runs = plain_runs(words)
    dropped = {i for a, b, q in runs for i in range(a + q, b)}
    best = max(sorted((a, b - a, q) for a, b, q in runs), key=lambda r: Fraction(r[1], r[2]), default=None)
    listed = "".join(f"{a},{b - a},{q}\n" for a, b, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return len(runs), best, listed, " ".join(w for i, w in enumerate(words) if i not in dropped)


def runs_of(texts, least_words, least_periods):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    seq = np.array([x for t in texts for x in t], np.uint64)
    out = [[] for _ in texts]
    for a, b, q in find_runs(seq, first, least_words, least_periods).tolist():
        i = int(np.searchsorted(first, a, "right")) - 1
        out[i].append((a - int(first[i]), b - int(first[i]), q))
    return [sorted(x) for x in out]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4), st.sampled_from([(24, 3), (6, 3), (4, 2), (2, 2), (10, 2), (1, 4)]))
def test_small_alphabets(texts, least):
    assert runs_of(texts, *least) == [plain_runs(t, *least) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 9), st.integers(0, 39)), min_size=1, max_size=5))
def test_powers_in_a_row(parts):
    text = [x for base, times, more in parts for x in base * times + base[:more]]
    assert runs_of([text, text[:50], []], 24, 3) == [plain_runs(text), plain_runs(text[:50]), []]


def test_long_texts_of_one_word_and_nested_runs():
    assert runs_of([[7] * 60_000], 24, 3) == [[(0, 60_000, 1)]]
    base = [1] * 40 + list(range(2, 500))
    text = base * 5
    assert runs_of([text], 24, 3) == [plain_runs(text)] and (0, len(text), len(base)) in runs_of([text], 24, 3)[0]
    random.seed(3)
    blocks = [random.randrange(1000) for _ in range(3000)]
    assert runs_of([blocks * 3 + blocks[:17]], 24, 3) == [[(0, 9017, 3000)]]


def test_agrees_with_trying_all_periods(documents):
    random.seed(5)
    base = [random.choice("ab cd ef gh Ab".split()) for _ in range(30)]
    texts = [None, "", " \n", "one", "a " * 23, "a " * 24, "\t".join("a" * 24), " ".join(base * 4), "x " + " ".join(base[:9] * 3) + " y\n" + "b c " * 20, "é x " * 30, "q " * 30_000]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(4, texts[7])])
    done = collapse_runs(docs, keep=["doc_id", "text", "score"])
    assert done.columns == ["doc_id", "text", "score", "n_runs", "runs", "longest", "collapsed"]
    found = done.collect()
    assert len(found) == len(texts) + 1
    for r in found:
        words = WORD.findall(r.text or "")
        if len(words) > 10_000:
            assert (r.n_runs, tuple(r.longest), r.collapsed) == (1, (0, 30_000, 1), "q")
            continue
        n, best, listed, collapsed = plain_row(words)
        assert (r.n_runs, r.collapsed) == (n, collapsed)
        assert (None if r.longest is None else tuple(r.longest)) == best
        assert "".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs) == listed


def test_empty_table(documents):
    assert collapse_runs(documents([(1, "a")]).where("false")).count() == 0


def test_query_plants_and_digests(spark, sf_dir):
    rows = {r.doc_id: r for r in op12_runs(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    planted = 0
    for doc_id, text in docs:
        words, h = WORD.findall(text or ""), crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)], planted + 1
        elif len(words) > 2000:
            continue
        n, best, listed, collapsed = plain_row(words)
        r, digest = rows[doc_id], lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_runs, r.runs_sha256, r.collapsed_sha256) == (n, digest(listed), digest(collapsed))
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
    assert planted > 5 and len(rows) == len(docs)
