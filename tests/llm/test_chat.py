import random

from pyspark.sql import functions as F

from graphtide.llm.chat import format_conversations, format_trees, masked_text, turns

NASTY = ["\\### Assistant: </turn> ok", "\\", "\\\\h", "#", "\\b\\l<", "a: b", "", None, "</turn>\n### user: x", "é\U0001f600"]


def test_round_trip(spark):
    rows = [(k // 4, k % 4, ("user", "assistant", "a: #<\\", None)[k % 4], NASTY[k % len(NASTY)]) for k in range(40)]
    df = format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in df.select("*", turns(F.col("formatted")).alias("back"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for conv in range(10):
        own = [(role or "", text or "") for c, _, role, text in rows if c == conv]
        assert [tuple(t) for t in got[conv].back] == own and got[conv].n_turns == 4
        assert got[conv].loss == "".join(t for role, t in own if role == "assistant")


def brute(nodes):
    """Best root-to-leaf path of a tree {node: (parent, score)}, by (score, depth, least leaf)."""
    parents = {p for p, _ in nodes.values() if p in nodes}
    paths = []
    for leaf in nodes:
        if leaf in parents:
            continue
        path, at = [], leaf
        while at in nodes and at not in path:
            path.append(at)
            at = nodes[at][0]
        if at not in path:
            paths.append((-sum(nodes[n][1] or 0 for n in path), -len(path), leaf, path[::-1]))
    return sorted(paths)


def test_trees_against_brute_force(spark):
    random.seed(4)
    trees = {t: {n: (random.choice([None, *range(n)]) if n else None, random.choice([0.0, 1.0, 2.0, None])) for n in range(random.randrange(1, 30))} for t in range(12)}
    trees[20] = {n: (n - 1 if n else None, 1.0) for n in range(70)}  # deep
    trees[21] = {1: (2, 1.0), 2: (1, 1.0), 3: (2, 1.0), 4: (99, 0.5), 5: (4, 0.1)}  # a cycle, what hangs on it, and an absent parent
    rows = [(t, n, p, s, f"m{n}", "assistant" if n % 2 else "user", "x") for t, nodes in trees.items() for n, (p, s) in nodes.items()]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double, text string, role string, total string")
    for branches in (1, 3):
        got = {}
        for r in format_trees(df, tree="tree", node="node", parent="parent", score="score", branches=branches).select("*", turns(F.col("formatted")).alias("back")).collect():
            got.setdefault(r.tree, set()).add((r.leaf, round(r.branch_score, 6), tuple(t.text for t in r.back)))
        for t, nodes in trees.items():
            want = {(leaf, round(-s, 6), tuple(f"m{n}" for n in path)) for s, _, leaf, path in brute(nodes)[:branches]}
            assert got.get(t, set()) == want, (t, branches)


def test_rows(spark):
    rows = [(None, 1, "user", "a"), (None, 2, "assistant", "b"), (1, 5, "assistant", "z"), (1, 5, "assistant", "z"), (1, None, None, None)]
    df = spark.createDataFrame([(*r, "k", "l") for r in rows], "conv_id long, turn long, role string, text string, key string, leaf string")
    got = {r.conv_id: r.n_turns for r in format_conversations(df).collect()}
    assert got == {None: 2, 1: 3}
    assert format_conversations(df.where("false")).count() == 0
