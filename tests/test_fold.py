from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphtide.operators import fold, project, verify
from graphtide.sources.snapshot import snapshot_rows
from tests.samples import DEPOT, PORT, change, feed

CRATE, CHANNEL, LEASE, BERTH = (DEPOT.label("crate"), PORT.label("channel"), PORT.label("lease"),
                                 PORT.label("berth"))


def changes(spark, label, *texts):
    return project.decode_label(feed(spark, *texts), label)


def berth(op, at, age=30, pid="p1", name="north"):
    return change(op, "berth", {"berthno": pid, "age": age, "name": name}, at)


def test_vertex_scenario(spark, rows):
    """Insert, update, delete: seen, replaced, gone."""
    steps = [berth("c", 1), berth("u", 2, 31), berth("d", 3, 31)]
    want = [[("p1", "north", 30)], [("p1", "north", 31)], []]
    for n, expected in enumerate(want, 1):
        state = fold.current_state(changes(spark, BERTH, *steps[:n]), BERTH)
        ids = spark.createDataFrame([("p1",), ("p1",), ("p9",)], "_vid string")
        assert rows(verify.lookup_vertices(state, ids)) == expected


def test_edge_scenario(spark, rows):
    def link(op, at, depth):
        return change(op, "channel", {"from_berth": "p1", "to_berth": "p2", "depth": depth}, at)

    steps = [link("c", 1, 41), link("u", 2, 42), link("d", 3, 42)]
    for n, expected in enumerate([[("p1", "p2", 0, 41)], [("p1", "p2", 0, 42)], []], 1):
        state = fold.current_state(changes(spark, CHANNEL, *steps[:n]), CHANNEL)
        pairs = spark.createDataFrame([("p1", "p2"), ("p2", "p1")], "_src string, _dst string")
        assert rows(verify.fetch_edges(state, pairs)) == expected


def test_deleting_a_vertex_leaves_its_edges(spark, rows):
    texts = [berth("c", 1), change("c", "channel", {"from_berth": "p1", "to_berth": "p2", "depth": 1}, 2),
             berth("d", 3)]
    assert rows(fold.current_state(changes(spark, BERTH, *texts), BERTH)) == []
    assert len(rows(fold.current_state(changes(spark, CHANNEL, *texts), CHANNEL))) == 1


def test_parallel_edges_collapse_without_a_rank(spark, rows):
    stints = [change("c", "lease", {"berthno": "p1", "harbourno": "t1", "opened": y, "closed": y + 1}, at)
              for at, y in enumerate((1999, 2010))]
    state = fold.current_state(changes(spark, LEASE, *stints), LEASE)
    assert rows(state) == [("p1", "t1", 0, 2010, 2011)]


def test_same_second_changes_channel_their_position(spark, rows):
    texts = [berth("u", 9, 40), berth("c", 7), berth("d", 8), berth("u", 10, 41)]
    assert rows(fold.current_state(changes(spark, BERTH, *texts), BERTH)) == [("p1", "north", 41)]


def test_ties_are_settled_the_same_way(spark, rows):
    tied = [berth("u", 1, 40), berth("u", 1, 41), berth("u", 1, 39)]
    for texts in (tied, tied[::-1], tied + tied):
        assert rows(fold.current_state(changes(spark, BERTH, *texts), BERTH)) == [("p1", "north", 41)]
    with_delete = [*tied, berth("d", 1, 0)]
    for texts in (with_delete, with_delete[::-1]):
        assert rows(fold.current_state(changes(spark, BERTH, *texts), BERTH)) == []


def test_file_order_beats_position(spark, rows):
    def at(file, pos, age):
        seq = {"ts_sec": 5, "file": file, "pos": pos, "row": 0}
        return change("u", "berth", {"berthno": "p1", "age": age, "name": "x"}, seq=seq)

    texts = [at("bin.000002", 4, 2), at("bin.000001", 900, 1)]
    assert rows(fold.current_state(changes(spark, BERTH, *texts), BERTH)) == [("p1", "x", 2)]


def test_snapshot_loses_to_any_change(spark, rows):
    table = spark.createDataFrame([("p1", "north", 1), ("p2", "south", 2)], "berthno string, name string, age int")
    tail = changes(spark, BERTH, berth("u", 0, 5))
    both = fold.bootstrap_then_tail(snapshot_rows(table, BERTH), tail)
    assert rows(fold.current_state(both, BERTH)) == [("p1", "north", 5), ("p2", "south", 2)]


def test_deleted_keys(spark, rows):
    texts = [berth("c", 1), berth("d", 2), berth("d", 1, pid="p2"), berth("c", 2, pid="p2")]
    assert rows(fold.deleted_keys(changes(spark, BERTH, *texts), BERTH)) == [("p1",)]


def brute_force(history):
    """Last change per id, by position, then delete, then values."""
    newest = {}
    for op, vid, pos, name, age in history:
        version = (pos, op == "d", name or "", -1 if age is None else age)
        newest[vid] = max(newest.get(vid, version), version)
    return sorted(((v, n, a) for v, (_, dead, n, a) in newest.items() if not dead), key=repr)


HISTORY = st.lists(
    st.tuples(st.sampled_from("rcud"), st.integers(1, 4), st.integers(0, 6), st.sampled_from("ab"),
              st.integers(0, 3)), min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.generate])
@given(HISTORY, st.randoms(use_true_random=False), st.integers(0, 25))
def test_fold_properties(spark, rows, history, random, cut):
    """Order, repetition and splitting of a feed do not matter."""
    texts = [change(op, "crate", {"id": vid, "name": n, "age": a}, pos) for op, vid, pos, n, a in history]
    want = brute_force(history)
    mixed = texts + random.sample(texts, len(texts) // 2)
    random.shuffle(mixed)
    assert rows(fold.current_state(changes(spark, CRATE, *mixed), CRATE)) == want
    parts = [fold.latest_changes(changes(spark, CRATE, *p), CRATE) for p in (texts[:cut], texts[cut:]) if p]
    merged = parts[0] if len(parts) == 1 else fold.merge_latest(*parts, CRATE)
    assert rows(fold.alive(merged, CRATE)) == want


def test_fold_combines_before_its_only_shuffle(spark, plan):
    text = plan(fold.current_state(changes(spark, CRATE, change("c", "crate", {"id": 1})), CRATE))
    assert text.count("Exchange") == 1
    assert text.index("partial_max") > text.index("Exchange")  # printed top down: below the shuffle


def test_hot_key(spark, rows):
    """One id owns nearly all changes; it still leaves one row per task before the shuffle."""
    hot = spark.range(0, 20_000, numPartitions=4).select(
        F.format_string('{"op":"u","ts_sec":1,"db":"yard","table":"crate","data":{"id":%d,"age":%d},'
                        '"seq":{"ts_sec":1,"file":"","pos":%d,"row":0}}',
                        F.when(F.col("id") < 19_990, 7).otherwise(F.col("id")), F.col("id") % 100,
                        F.col("id")).alias("value"), F.lit("db_1").alias("source"))
    state = fold.current_state(project.decode_label(hot, CRATE), CRATE)
    got = rows(state.select("_vid", "age"))
    assert len(got) == 11 and (7, 19_989 % 100) in got


# -- read-back -----------------------------------------------------------------


def edges(spark, items):
    return spark.createDataFrame(items, "_src int, _dst int, _rank bigint, w int")


def test_one_hop_with_a_hot_source(spark, rows):
    many = edges(spark, [(1, i, 0, i) for i in range(500)] + [(2, 5, 0, 1), (2, 5, 1, 1), (3, 1, 0, 1)])
    seeds = spark.createDataFrame([(1,), (2,), (2,), (9,)], "_src int")
    want = sorted([(1, i, 0) for i in range(500)] + [(2, 5, 0), (2, 5, 1)], key=repr)
    heavy = verify.heavy_keys(many)
    assert len(heavy) == 1
    for given, salts in (((), 16), (heavy, 1), (heavy, 16)):
        assert rows(verify.one_hop(many, seeds, heavy=given, salts=salts)) == want
    # The request's type does not matter, though hashes tell types apart.
    assert rows(verify.one_hop(many, seeds.select(F.col("_src").cast("bigint")), heavy=heavy)) == want


def test_only_heavy_keys_are_spread(spark, monkeypatch):
    many = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("_src"), F.col("id").alias("_dst"), F.lit(0).cast("bigint").alias("_rank"))
    heavy = verify.heavy_keys(many)
    zero = spark.range(1).select(F.xxhash64("id")).head()[0]
    assert heavy == [zero]
    sides = {}
    kind = type(many)
    real = kind.join

    def spy(left, right, on, how):
        sides.update(left=left, right=right, on=on)
        return real(left, right, on, how)

    monkeypatch.setattr(kind, "join", spy)
    verify.one_hop(many, spark.range(1000).withColumnRenamed("id", "_src"), heavy=heavy)
    monkeypatch.undo()
    assert sides["right"].count() == 1000 - 1 + verify.SALTS
    sizes = sorted(r["count"] for r in sides["left"].where("_src = 0").groupBy("_salt").count().collect())
    assert len(sizes) == verify.SALTS and sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert verify.heavy_keys(spark.range(1000).withColumnRenamed("id", "_src")) == [] and verify.heavy_keys(many.where("false")) == []


def test_fetch_returns_every_rank(spark, rows):
    many = edges(spark, [(1, 2, r, r) for r in range(50)] + [(1, 3, 0, 0)])
    pairs = spark.createDataFrame([(1, 2), (1, 2), (4, 4)], "_src int, _dst int")
    assert len(rows(verify.fetch_edges(many, pairs))) == 50


def test_lookup_shuffles_ids_once(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vertices = spark.range(10).select(F.col("id").alias("_vid"))
        text = plan(verify.lookup_vertices(vertices, spark.range(5).select(F.col("id").alias("_vid"))))
        assert text.count("Exchange") == 2  # one per side, the distinct shares its own
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stats(spark, rows):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "_vid int")

    stats = verify.graph_stats(
        {("a", "a.dog"): ids(1, 2, 3), ("a", "a.cat"): ids(3, 4), ("a", "a.owl"): ids(), ("b", "b.dog"): ids(1, 9)},
        {("a", "a.near"): edges(spark, [(1, 3, 0, 0), (1, 4, 0, 0)]), ("a", "a.far"): edges(spark, [])},
    )
    assert rows(stats) == [
        ("a", "Edge", "a.far", 0), ("a", "Edge", "a.near", 2), ("a", "Space", "edges", 2), ("a", "Space", "vertices", 4),
        ("a", "Tag", "a.cat", 2), ("a", "Tag", "a.dog", 3), ("a", "Tag", "a.owl", 0),
        ("b", "Space", "vertices", 2), ("b", "Tag", "b.dog", 2)]


def test_reconcile(spark, rows, plan):
    ddl = "k int, a string, b int"
    source = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "z", 3), (4, None, 4), (6, "d", 1), (6, "d", 1)], ddl)
    graph = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "q", 9), (4, "n", 4), (5, "e", 5), (6, "d", 1)], ddl)
    found = verify.reconcile(source, graph, ["k"])
    assert rows(found) == [(3, "differs", ["a", "b"]), (4, "differs", ["a"]), (5, "extra", []), (6, "repeated", [])]
    assert rows(verify.reconcile(graph, graph, ["k"])) == []
    assert rows(verify.reconcile(source, graph.where("false"), ["k"]).select("status").distinct()) == [("missing",)]
    assert plan(found).count("Exchange") == 1


def test_reconcile_by_ranges_moves_few_rows(spark, rows):
    graph = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("a"), F.lit(None).cast("string").alias("b"))
    # One in a thousand differs: a value, a null that changed places, a key that is gone, new or repeated.
    odd = F.col("k") % 5000
    source = graph.where(odd != 3).withColumn("a", F.when(odd == 1, "other").when(odd == 2, None).otherwise(F.col("a"))).withColumn(
        "b", F.when(odd == 2, F.concat(F.lit("v"), F.col("k"))).otherwise(F.col("b")))
    source = source.unionByName(source.where(odd == 4)).unionByName(graph.where(odd == 5).withColumn("k", F.col("k") + 100_000))
    want = rows(verify.reconcile(source, graph, ["k"]))
    assert len(want) == 20 and {r[1] for r in want} == {"differs", "missing", "extra", "repeated"}
    assert rows(verify.reconcile_ranges(source.select(F.col("k").cast("int"), "b", "a"), graph, ["k"])) == want
    moved = sum(side.count() for side in verify.unequal_rows(source, graph, ["k"]))
    assert moved < 0.02 * (source.count() + graph.count())
    assert all(side.count() == 0 for side in verify.unequal_rows(graph, graph, ["k"]))
    assert rows(verify.reconcile_ranges(source, graph, ["k"], rows=1)) == want
    assert verify.reconcile_ranges(graph.where("false"), graph.where("false"), ["k"]).count() == 0
