import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphtide.llm import token_groups
from graphtide.llm.queries import op13_token_groups
from graphtide.llm.token_groups import Sets, frequent_shingles, link_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain_components(rows):
    """(doc_id, n_shingles, component_id) by comparing documents that share a shingle."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    first, holders = {}, defaultdict(list)
    for i, s in enumerate(sets):
        if s and s in first:
            up[root(i)] = root(first[s])
        elif s:
            first[s] = i
            for x in s:
                holders[x].append(i)
    for i in first.values():
        common = defaultdict(int)
        for x in sets[i]:
            for j in holders[x]:
                common[j] += j < i
        for j, c in common.items():
            if 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] += [doc_id] if doc_id is not None else []
    return sorted(((d, len(s), min(least[root(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def families(seed):
    """Copies with few to many changed words, a passage that most share, and texts of a few words."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(25)]
    texts = [None, "", " \n", "one", "ONE", "one two three four", "One two\tthree four", "one two three four five", "one two three four six"]
    for family in range(14):
        base = [word() for _ in range(rng.choice([8, 40, 120]))]
        for _ in range(rng.choice([2, 3, 60])):
            copy = base[:]
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = word()
            if family % 3 == 0:
                at = rng.randrange(len(copy))
                copy[at:at] = passage
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [word() for _ in range(rng.choice([1, 3, 6, 30]))]) for _ in range(80)]
    return list(enumerate(texts))


def test_sets_are_distinct_shingles():
    texts = ["a b c d e a b c d e", None, "x", "A b C d E", "a b c d e", "é ü"]
    sets = Sets(pa.array(texts))
    assert sets.count.tolist() == [len(shingles(t)) for t in texts]
    keys = sets.keys().to_pylist()
    assert keys[1] is None and keys[3] == keys[4] and len(set(keys)) == 5
    assert all((np.diff(sets.code[a:b].astype(object)) > 0).all() for a, b in zip(sets.first, sets.first[1:]))


@pytest.mark.parametrize("small", [False, True])
def test_agrees_with_comparing_all(documents, monkeypatch, small):
    if small:  # many blocks, groups, turns and frequent shingles, and no broadcast
        for name, value in {"BLOCK_NODES": 4, "GROUP_NODES": 2, "QUERIES": 3, "FREQUENT": 3, "BROADCAST_ROWS": 0, "MOST_FREQUENT": 200}.items():
            monkeypatch.setattr(token_groups, name, value)
    rows = families(7 + small)
    rows += [rows[20], rows[20], (None, rows[21][1]), (None, "nobody else says this at all"), (None, None)]
    docs = documents(rows).withColumn("Component_ID", F.lit("own"))
    done = link_documents(docs)
    assert done.columns == [c for c in docs.columns if c != "Component_ID"] + ["n_shingles", "component_id"]
    assert found(done) == plain_components(rows)


def test_long_texts_and_empty_tables(documents):
    rng = random.Random(2)
    base = [f"w{rng.randrange(50)}" for _ in range(40_000)]
    rows = [(3, " ".join(base)), (2, " ".join(base[:36_000])), (1, " ".join(base[:20_000])), (0, "w1 " * 30_000)]
    assert found(link_documents(documents(rows))) == plain_components(rows)
    assert link_documents(documents(rows).where("false")).count() == 0


def test_frequent_shingles_are_counted_over_all_documents(documents, monkeypatch):
    monkeypatch.setattr(token_groups, "FREQUENT", 8)
    texts = ["common words that all of these have " + f"x{i} y{i} z{i} u{i} v{i}" for i in range(64)] + ["just a few say this one " * 3] * 9
    upper, levels = frequent_shingles(documents(list(enumerate(texts))))
    code = Sets(pa.array(["common words that all of these have", texts[-1]]))
    want = {int(c >> np.uint64(32)): 6 if t == 0 else 3 for c, t in zip(code.code, code.text) if c < token_groups.COUNTED}
    assert dict(zip(upper.tolist(), levels.tolist())) == want


def test_query_on_the_given_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(op13_token_groups(spark, sf_dir)) == plain_components(rows)


def test_groups_of_a_large_family_ask_as_one(documents, monkeypatch):
    """Similar copies that hardly link: what many of them share meets a group once, not once for each of them."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        copy = base[:]
        for at in rng.sample(range(150), rng.choice([1, 4, 4, 4, 5])):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, t) for i, t in families(5)]
    lookup, met, asked = token_groups._lookup, [], []

    def watched(base, known):
        met.append(token_groups._meetings(token_groups._owned(base, known)).count())
        asked.append(lookup(base, known))
        return asked[-1]

    monkeypatch.setattr(token_groups, "_lookup", watched)
    monkeypatch.setattr(token_groups, "GROUP_NODES", 64)
    monkeypatch.setattr(token_groups, "ENTRIES", 500)  # several turns
    for together in (8, 1 << 40):  # nobody asks as one in the second pass
        monkeypatch.setattr(token_groups, "TOGETHER", together)
        assert found(link_documents(documents(rows))) == plain_components(rows)
    assert 4 * met[0] < met[1]
    assert asked[0].count() and sorted(asked[0].collect()) == sorted(asked[1].collect())
