import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from graphtide.llm.near_dup import BANDS, Bags, components, find_near_duplicates, signatures
from tests.llm.test_common import words


def bag(text):
    w = words(text)
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def classes(texts):
    """Classes of texts by brute force, as lists of positions."""
    bags, up = [bag(t) for t in texts], list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8:
                up[root(i)] = root(j)
    out = defaultdict(list)
    for i in range(len(texts)):
        out[root(i)].append(i)
    return sorted(out.values())


def found(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.class_id].append(r)
    assert all(sum(r.kept for r in rows) == 1 for rows in out.values())
    assert all(r.kept == (r.doc_id == r.class_id) for rows in out.values() for r in rows)
    return sorted(sorted(r.doc_id for r in rows) for rows in out.values())


def test_signatures_estimate_weighted_jaccard():
    random.seed(2)
    base = [f"w{random.randrange(40)}" for _ in range(300)]
    for change in (10, 40, 150):
        other = base[:]
        for at in random.sample(range(300), change):
            other[at] = f"v{at}"
        # Few different words and repeated stretches give weights above one.
        texts = [" ".join(x + x[:120] * 3) for x in (base, other)]
        signed = signatures(Bags(pa.array(texts)))
        got = np.mean(signed[0] == signed[1])
        want = similarity(bag(texts[0]), bag(texts[1]))
        assert abs(got - want) < 4 * (want * (1 - want) / signed.shape[1]) ** 0.5 + 0.01


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b", "x " * 500, " ".join(map(str, range(400))), ""]
    whole = signatures(Bags(pa.array(texts)))
    for k, text in enumerate(texts):
        assert (signatures(Bags(pa.array([text])))[0] == whole[k]).all()
    assert (whole[3] == 0).all() and BANDS * 6 == whole.shape[1]


def test_against_brute_force(spark, documents):
    random.seed(3)
    make = lambda n: [f"t{random.randrange(10**6)}" for _ in range(n)]
    texts = [" ".join(make(n)) for n in (1, 3, 5, 40, 200)]
    for family, edits in ((make(150), 8), (make(60), 3)):
        for _ in range(25):
            copy = family[:]
            for _ in range(random.randrange(edits)):
                copy[random.randrange(len(copy))] = make(1)[0]
            texts.append(" ".join(copy))
    texts += [texts[4].upper(), texts[4].replace(" ", " - "), texts[0], "p q " * 100, "p q " * 99]
    got = found(find_near_duplicates(documents(list(enumerate(texts))), keep=["doc_id"]))
    assert got == classes(texts)


def test_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " .,"), (4, "one"), (5, "One!"), (6, "two"), (7, "a b c d e"), (8, "a b c d e"), (8, "x y")]
    df = find_near_duplicates(documents(rows)).collect()
    assert len(df) == len(rows) and {"score", "node", "bucket"} <= set(df[0].asDict())
    ids = {r.doc_id: r.class_id for r in df if r.text != "x y"}
    assert ids[4] == ids[5] and ids[7] == ids[8] and len({ids[i] for i in (1, 2, 3, 4, 6, 7)}) == 6
    assert find_near_duplicates(documents(rows).where("false"), keep=["doc_id"]).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}


def test_clashing_columns(documents):
    docs = documents([(1, "a b c"), (2, "a b c")]).withColumnsRenamed({"kept": "Kept", "class_id": "CLASS_ID"})
    done = find_near_duplicates(docs)
    assert {r.class_id for r in done.collect()} in ({1}, {2}) and len({c.lower() for c in done.columns}) == len(done.columns)


def test_tiles_and_hot_copies_change_nothing(documents, monkeypatch):
    from graphtide.llm import near_dup

    random.seed(11)
    base = [f"w{random.randrange(200)}" for _ in range(60)]
    texts = []
    for _ in range(60):
        copy = base[:]
        for _ in range(random.choice([0, 1, 2, 3])):
            copy[random.randrange(60)] = f"v{random.randrange(900)}"
        texts.append(" ".join(copy))
    texts += [texts[0]] * 30 + [None, "", None]
    monkeypatch.setattr(near_dup, "TILE", 3)
    monkeypatch.setattr(near_dup, "STAR_ROUNDS", 1)
    assert found(find_near_duplicates(documents(list(enumerate(texts))))) == classes(texts)
