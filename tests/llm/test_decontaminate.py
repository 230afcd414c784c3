import random

from graphtide.llm.decontaminate import find_contamination
from tests.llm.test_common import words


def brute(text, items):
    doc, hit, found = words(text), set(), set()
    for item, passage in items:
        said = words(passage)
        n = min(10, len(said))
        for i in range(len(said) - n + 1) if n else ():
            for at in range(len(doc) - n + 1):
                if doc[at:at + n] == said[i:i + n]:
                    hit.update(range(at, at + n))
                    found.add(item or "")
    return len(doc), len(hit), sorted(found), bool(hit)


def test_against_brute_force_in_one_and_many_passes(spark, documents):
    random.seed(5)
    word = lambda: random.choice(["a", "B", "c9", "é"])
    items = [(str(k), " ".join(word() for _ in range(n))) for k, n in enumerate([1, 4, 9, 10, 11, 14, 30])] + [("7", None), ("8", " .,"), (None, "c9 c9 c9 c9 B")]
    items.append(items[4])
    texts = [(k, " ".join(word() for _ in range(random.choice([0, 3, 40, 700])))) for k in range(12)]
    texts += [(50, None), (51, ""), (52, items[5][1].upper().replace(" ", "--")), (53, "x " + items[6][1] + " y")] * 2
    benchmark = spark.createDataFrame(items[1:], "item_id string, text string")
    want = sorted((i, *brute(t, items[1:])) for i, t in texts)
    for limit in (1_000_000, 4):
        got = find_contamination(documents(texts), benchmark, keep=["doc_id", "label"], pass_windows=limit)
        rows = [(r.doc_id, r.n_words, r.n_hit, r.hit_items, r.contaminated) for r in got.collect()]
        assert sorted(rows) == want
        assert all(sum(b - a for a, b in zip(r.hit_words[::2], r.hit_words[1::2])) == r.n_hit for r in got.collect())


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(documents([(1, "a b")]), none).collect()[0].contaminated is False
    assert find_contamination(documents([(1, "a b")]).where("false"), none).count() == 0
