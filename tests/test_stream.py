import time
from dataclasses import replace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphtide.operators import fold, project
from graphtide.plans.spec import EdgeMap, KeyRef, Prop, VertexMap, spec_labels
from graphtide.sources.envelopes import decode_envelopes, stream_feed, write_feed
from graphtide.sources.snapshot import snapshot_envelopes
from graphtide.streaming.chunks import ChunkedSnapshot, chunk_bounds, in_chunk
from graphtide.streaming.files import byte_count
from graphtide.streaming.store import OPEN_TABLES, GraphStore
from graphtide.streaming.sync import bootstrap, start_sync, sync_available
from tests.samples import DEPOT, change, feed
from tests.test_operators import OAK, LINK

CRATE, LASHING = DEPOT.label("crate"), DEPOT.label("lashing")


def crate(op, vid, at, age=1):
    return change(op, "crate", {"id": vid, "name": "n", "age": age}, at)


def batch(spark, *texts):
    return decode_envelopes(feed(spark, *texts))


@pytest.fixture
def store(spark, tmp_path):
    return GraphStore(spark, str(tmp_path / "store"), DEPOT, buckets=3)


def test_batches_add_up_to_the_state(spark, rows, store):
    store.append(batch(spark, crate("c", 1, 1), crate("c", 2, 2), change("c", "lashing", LINK)), 0)
    store.append(batch(spark, crate("u", 1, 3, age=5), crate("d", 2, 4)), 1)
    assert rows(store.state("crate")) == [(1, "n", 5)]
    assert rows(store.state("lashing").select("_src", "_dst", "_rank", "level")) == [(8, 5, 3, 3)]


def test_empty_store(spark, rows, store):
    assert rows(store.state("lashing")) == []
    assert store.compact("lashing") is None
    store.append(batch(spark, crate("c", 1, 1)), 0)
    assert store.compact("lashing") == 0
    assert rows(store.state("lashing")) == []


def test_replayed_batch_changes_nothing(spark, rows, store):
    first = batch(spark, crate("c", 1, 1), crate("c", 2, 1))
    store.append(first, 0)
    store.append(first, 0)
    assert store.changes("crate").count() == 2
    store.append(first, 1)  # delivered again under another number
    assert rows(store.state("crate")) == [(1, "n", 1), (2, "n", 1)]


def test_unfinished_batch_is_invisible(spark, rows, store):
    store.append(batch(spark, crate("c", 1, 1)), 0)
    # A writer that died before its commit leaves files but no marker.
    store._logged(batch(spark, crate("c", 2, 2))).write.partitionBy("place").parquet(f"{store.root}/log/batch_id=1")
    assert rows(store.state("crate").select("_vid")) == [(1,)]
    store.append(batch(spark, crate("c", 3, 2)), 1)
    assert rows(store.state("crate").select("_vid")) == [(1,), (3,)]


def test_late_change_after_compaction_does_not_resurrect(spark, rows, store):
    store.append(batch(spark, crate("c", 1, 1), crate("d", 1, 9), crate("c", 2, 1)), 0)
    assert store.compact("crate") == 0
    store.append(batch(spark, crate("u", 1, 5), crate("u", 2, 5, age=7)), 1)
    assert rows(store.state("crate")) == [(2, "n", 7)]
    assert store.compact("crate") == 1
    assert rows(store.state("crate")) == [(2, "n", 7)]
    store.vacuum()  # the other label is not folded: its log must stay
    assert store.batches() == [0, 1]
    store.compact_all()
    store.append(batch(spark, crate("u", 1, 6), crate("c", 3, 1)), 2)
    store.vacuum()
    assert store.batches() == [1, 2]
    assert rows(store.state("crate").select("_vid")) == [(2,), (3,)]


def test_version_is_not_shuffled_when_changes_are_folded_in(spark, store, plan):
    store.append(batch(spark, *[crate("c", i, 1) for i in range(20)]), 0)
    store.compact("crate")
    store.append(batch(spark, crate("u", 1, 5)), 1)
    text = plan(store.latest("crate"))
    version = text[text.index("SortMergeJoin"):].splitlines()
    upper = next(i for i, line in enumerate(version) if "Bucketed: true" in line)
    assert not any("Exchange" in line for line in version[:upper])
    store.compact("crate")
    assert 1 <= len(parts(store, CRATE)) <= 3


def parts(store, label):
    home = f"{store.root}/base/{label.kind}-{label.label}/{store.versions(label)[-1].folder}"
    return [n for n in store.files.names(home) if n.startswith("part-")]


def test_unranked_edges_keep_their_buckets(spark, rows, tmp_path, plan):
    spec = spec_labels([EdgeMap("near", "s", "d", "near", (Prop("w", "w", "int"),), "db_1", src=KeyRef("a", "int"), dst=KeyRef("b", "int"))])
    store = GraphStore(spark, str(tmp_path), spec, buckets=4)
    near = lambda op, a, b, w, at: change(op, "crate", {"a": a, "b": b, "w": w}, at, table_name="near", db="d")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.append(batch(spark, *[near("c", k, k + 1, k, 1) for k in range(40)]), 0)
        store.compact("near")
        store.append(batch(spark, near("u", 3, 4, 99, 5), near("d", 5, 6, 0, 5)), 1)
        store.compact("near")
        store.append(batch(spark, near("c", 5, 6, 7, 9), near("c", 5, 7, 8, 9)), 2)
        assert 1 <= len(parts(store, spec.edges[0])) <= 4
        text = plan(store.latest("near"))
        assert "Bucketed: true" in text and "Bucketed: false" not in text
        for found in (store.fetch("near", spark.createDataFrame([(3, 4), (5, 6)], "_src int, _dst int")), store.latest("near")):
            upper = plan(found).split("Bucketed: true")[0]
            assert "SortMergeJoin" in upper
        pairs = spark.createDataFrame([(3, 4), (5, 6), (0, 9)], "_src int, _dst int")
        assert rows(store.fetch("near", pairs)) == [(3, 4, 0, 99), (5, 6, 0, 7)]
        assert rows(store.one_hop("near", spark.createDataFrame([(5,)], "_src long"))) == [(5, 6, 0), (5, 7, 0)]
        assert store.state("near").count() == 41
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_change_is_logged_once_in_few_files(spark, tmp_path):
    labels = [VertexMap(f"v{k}", "s", "yard", "crate", source="db_1", id=KeyRef("id", "int")) for k in range(6)]
    store = GraphStore(spark, str(tmp_path), spec_labels(labels), log_files=2)
    store.append(batch(spark, *[crate("c", k, k) for k in range(40)]).repartition(8), 0)
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.count() == 40 and len(log.inputFiles()) <= 2
    assert all(store.state(f"s.v{k}").count() == 40 for k in range(6))


def test_a_large_batch_is_logged_by_more_tasks(spark, store):
    few = GraphStore(spark, store.root, store.spec, buckets=3, log_files=1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        few.append(batch(spark, *[crate("c", k, k) for k in range(4000)]).repartition(8), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spark.read.parquet(f"{store.root}/log").inputFiles()) >= 4
    assert few.state("crate").count() == 4000


def test_a_large_batch_is_logged_where_it_is(spark, store):
    few = GraphStore(spark, store.root, store.spec, buckets=3, log_files=1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        few.append(batch(spark, *[crate("c", k, k) for k in range(400)]).repartitionByRange(4, "seq"), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    log = spark.read.parquet(f"{store.root}/log").groupBy(F.input_file_name()).agg(F.min("seq.pos").alias("low"), F.max("seq.pos").alias("high"))
    found = sorted((r["low"], r["high"]) for r in log.collect())
    assert len(found) > 1 and all(a[1] < b[0] for a, b in zip(found, found[1:]))  # no file has rows of two tasks
    assert few.state("crate").count() == 400
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_small_files_of_many_tasks_are_merged(spark, store):
    few = GraphStore(spark, store.root, store.spec, buckets=3, log_files=2, keep_rejects=True)
    changes = batch(spark, *[crate("c", k, k) for k in range(60)], *[change("c", "lashing", LINK | {"inner": k}) for k in range(60)], "junk")
    for _ in range(2):  # the second replaces the first
        few.append(changes.repartition(12), 0)
        log = spark.read.parquet(f"{store.root}/log")
        assert sorted(tuple(r) for r in log.groupBy("place").count().collect()) == [("_rejected", 1), ("db_1.yard.crate", 60), ("db_1.yard.lashing", 60)]
        assert len(log.inputFiles()) <= 5
    assert few.state("crate").count() == 60


def test_a_fold_leaves_no_shuffle_on_disk(spark, store):
    def shuffles():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {n for n in manager.getAllFiles().mkString("\n").split("\n") if n.rpartition("/")[2].startswith("shuffle_")}

    store.append(batch(spark, *[crate("c", k, k) for k in range(60)]).coalesce(1), 0)
    before = shuffles()
    store.compact("crate")
    until = time.time() + 20  # files go in the background
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert store.state("crate").count() == 60


def test_a_task_may_hold_more_tables_than_files_are_kept_open(spark, tmp_path):
    names = [f"t{k}" for k in range(OPEN_TABLES + 4)]
    labels = [VertexMap(n, "s", "yard", n, source="db_1", id=KeyRef("id", "int")) for n in names]
    store = GraphStore(spark, str(tmp_path), spec_labels(labels))
    store.append(batch(spark, *[change("c", "crate", {"id": k}, k + 1, table_name=n) for k in range(3) for n in names]).coalesce(1), 0)
    assert all(store.state(f"s.{n}").count() == 3 for n in names)


@pytest.mark.parametrize("size, count", [("64MB", 64 << 20), ("8k", 8192), ("67108864b", 67108864), ("1g", 1 << 30), ("12", 12)])
def test_byte_count(size, count):
    assert byte_count(size) == count


def test_feed_and_store_are_compressed(spark, rows, store, tmp_path):
    feed = str(tmp_path / "feed")
    for k in range(2):
        write_feed(spark.createDataFrame([(crate("c", k, k),)], "value string"), feed)
    assert all(f.endswith(".txt.gz") for f in spark.read.text(feed).inputFiles())
    sync_available(stream_feed(spark, feed).withColumn("source", F.lit("db_1")), store, str(tmp_path / "checkpoint"))
    store.compact("crate")
    assert rows(store.state("crate").select("_vid")) == [(0,), (1,)]
    files = [*spark.read.parquet(f"{store.root}/log").inputFiles(), *spark.read.parquet(f"{store.root}/base/vertex-depot.crate/*").inputFiles()]
    assert len(files) > 1 and all(f.endswith(".zstd.parquet") for f in files)


def test_a_mapping_may_grow(spark, rows, store, tmp_path):
    store.append(batch(spark, crate("c", 1, 1, age=5)), 0)
    store.compact("crate")
    store.append(batch(spark, crate("c", 2, 2, age=6)), 1)
    grown = replace(CRATE, props=(*CRATE.props, Prop("more", "colour", "string")))
    added = VertexMap("again", "depot", "yard", "crate", (Prop("age", "age", "int"),), "db_1", id=KeyRef("id", "int"))
    later = GraphStore(spark, store.root, spec_labels([grown, added]), buckets=3)
    assert rows(later.state("crate")) == [(1, "n", 5, None), (2, "n", 6, None)]
    assert rows(later.state("again")) == [(1, 5), (2, 6)]


def test_batch_numbers_are_protected(spark, rows, store, tmp_path):
    put(spark, tmp_path, crate("c", 1, 1))
    sync(spark, store, tmp_path)
    put(spark, tmp_path, crate("c", 2, 2), folder="more")
    text = stream_feed(spark, str(tmp_path / "more")).withColumn("source", F.lit("db_1"))
    sync_available(text, store, str(tmp_path / "another"))
    assert rows(store.state("crate").select("_vid")) == [(1,), (2,)] and store.batches() == [1, 2]
    with pytest.raises(ValueError, match="belongs"):
        store.append(batch(spark, crate("c", 9, 9)), 1)
    store.compact_all()
    with pytest.raises(ValueError, match="not be read"):
        store.append(batch(spark, crate("c", 4, 4)), 0)
    store.append(batch(spark, crate("c", 5, 5)), 3, "me")
    store.compact_all()
    store.append(batch(spark, crate("c", 6, 6)), 3, "me")  # folded already: nothing happens
    assert rows(store.state("crate").select("_vid")) == [(1,), (2,), (5,)]


def test_values_that_do_not_fit_are_rejected(spark, rows, tmp_path):
    store = GraphStore(spark, str(tmp_path), DEPOT, keep_rejects=True)
    wrong = [crate("u", 1, 5, age="abc"), crate("c", 3_000_000_000, 1), change("c", "crate", {"name": "x"}, 2)]
    store.append(batch(spark, crate("c", 1, 1, age=4), crate("d", 2, 3, age="abc"), *wrong), 0)
    assert rows(store.state("crate")) == [(1, "n", 4)]
    assert rows(store.rejects().select("reason", "envelope")) == sorted(
        [("bad_value", wrong[0]), ("bad_value", wrong[1]), ("null_key", wrong[2])], key=repr)


def test_another_session_reads_the_version(spark, rows, store):
    store.append(batch(spark, crate("c", 1, 1)), 0)
    store.compact_all()
    spark.sql(f"DROP TABLE {store._table(CRATE, store.versions(CRATE)[-1])}")
    again = GraphStore(spark, store.root, DEPOT)
    assert rows(again.state("crate")) == [(1, "n", 1)]


def test_rebucket(spark, rows, store):
    store.append(batch(spark, *[crate("c", i, 1) for i in range(20)]), 0)
    store.compact("crate")
    store.rebucket("crate", 5)
    assert store.versions("crate") == [(0, 0, 3), (0, 1, 5)]
    with pytest.raises(ValueError, match="already"):
        store.rebucket("crate", 5)
    store.rebucket("crate", 2)
    assert store.state("crate").count() == 20
    store.compact_all()
    store.vacuum()
    assert store.versions("crate") == [(0, 2, 2)] and store.state("crate").count() == 20


def test_lookups_fold_only_what_they_need(spark, rows, store):
    store.append(batch(spark, *[crate("c", i, 1) for i in range(20)], change("c", "lashing", LINK)), 0)
    store.compact_all()
    store.append(batch(spark, crate("d", 3, 5), crate("u", 4, 5, age=9),
                       change("u", "lashing", {**LINK, "note": "new"}, 4)), 1)
    ids = spark.createDataFrame([(3,), (4,), (5,), (99,)], "_vid int")
    assert rows(store.lookup("crate", ids)) == [(4, "n", 9), (5, "n", 1)]
    pairs = spark.createDataFrame([(8, 5)], "_src int, _dst int")
    assert rows(store.fetch("lashing", pairs).select("note")) == [("new",)]


def test_live_keys_read_no_properties(spark, rows, store, plan):
    store.append(batch(spark, crate("c", 1, 1), crate("d", 2, 1)), 0)
    store.compact("crate")
    store.append(batch(spark, crate("c", 3, 1)), 1)
    keys = store.live_keys("crate")
    assert rows(keys) == [(1,), (3,)]
    assert "name" not in plan(keys)


def test_rejects_are_kept_on_request(spark, rows, tmp_path):
    store = GraphStore(spark, str(tmp_path), DEPOT, keep_rejects=True)
    odd = [change("t", "crate", {"id": 1}), change("c", "crate", OAK, db="nowhere"), "junk"]
    store.append(batch(spark, crate("c", 1, 1), *odd), 0)
    assert rows(store.rejects().select("reason", "envelope")) == sorted(
        [("bad_op", odd[0]), ("unrouted", odd[1]), ("bad_json", "junk")], key=repr)
    assert store.state("crate").count() == 1


def test_vacuum_moves_the_rejects_of_dropped_batches(spark, rows, tmp_path):
    store = GraphStore(spark, str(tmp_path), DEPOT, keep_rejects=True)
    reasons = lambda: [r[0] for r in rows(store.rejects().select("reason"))]
    store.append(batch(spark, crate("c", 1, 1), "junk", crate("u", 1, 5, age="abc")), 0)
    store.append(batch(spark, crate("c", 2, 1), change("t", "crate", {"id": 1})), 1)
    before = reasons()
    assert before == ["bad_json", "bad_op", "bad_value"]
    store.compact_all()
    store.vacuum()
    assert store.files.names(f"{tmp_path}/log") == [] and reasons() == before
    store.vacuum()
    assert reasons() == before
    store.append(batch(spark, crate("c", 3, 1), "more junk"), 2)
    assert reasons() == ["bad_json", *before]
    store.compact_all()
    store.vacuum()
    assert reasons() == ["bad_json", *before] and store.state("crate").count() == 3


def test_stats(spark, rows, store):
    store.append(batch(spark, crate("c", 1, 1), crate("c", 2, 1), change("c", "lashing", LINK)), 0)
    assert ("depot", "Space", "vertices", 2) in rows(store.stats()) and ("depot", "Edge", "depot.lashing", 1) in rows(store.stats())


def test_snapshot_then_stream(spark, rows, store, tmp_path):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, age int")
    bootstrap(store, snapshot_envelopes(table, "yard", "crate", ["id"]).withColumn("source", F.lit("db_1")))
    put(spark, tmp_path, crate("u", 1, 1, age=50), crate("d", 2, 2))
    sync(spark, store, tmp_path)
    assert rows(store.state("crate")) == [(1, "n", 50)]


def test_snapshot_loaded_as_version(spark, rows, store):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (2, "b", 2)], "id int, name string, age int")
    store.load_snapshot("crate", table)
    assert rows(store.state("crate")) == [(1, "a", 1), (2, "b", 2)]
    assert rows(store.state("lashing")) == []
    store.append(batch(spark, crate("d", 1, 1), crate("u", 2, 1, age=9)), 1)
    assert rows(store.state("crate")) == [(2, "n", 9)]
    with pytest.raises(ValueError, match="already"):
        store.load_snapshot("crate", table)


def test_label_fed_by_two_sources(spark, rows, tmp_path):
    here = replace(CRATE, props=CRATE.props)
    there = VertexMap("crate", "depot", "yard", "staff", (Prop("name", "full_name"), Prop("age", "age", "int")),
                      source="db_2", id=KeyRef("staff_id", "int"))
    spec = spec_labels([here, there])
    store = GraphStore(spark, str(tmp_path), spec, buckets=2)
    staff = change("c", "crate", {"staff_id": 2, "full_name": "x", "age": 3}, table_name="staff")
    first = feed(spark, crate("c", 1, 1)).unionByName(feed(spark, staff, source="db_2"))
    store.append(decode_envelopes(first), 1)
    assert rows(store.state("crate")) == [(1, "n", 1), (2, "x", 3)]
    direct = fold.current_state(project.graph_changes(decode_envelopes(first), spec, here), here)
    assert rows(direct) == rows(store.state("crate"))
    store.compact_all()
    gone = feed(spark, change("d", "crate", {"staff_id": 2}, 5, table_name="staff"), source="db_2")
    store.append(decode_envelopes(gone), 2)
    assert rows(store.live_keys("crate")) == [(1,)]
    assert ("depot", "Tag", "depot.crate", 1) in rows(store.stats())


def put(spark, tmp_path, *texts, folder="feed"):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(
        str(tmp_path / folder))


def sync(spark, store, tmp_path, **kwargs):
    text = stream_feed(spark, str(tmp_path / "feed"), max_files_per_trigger=1).withColumn("source", F.lit("db_1"))
    sync_available(text, store, str(tmp_path / "checkpoint"), **kwargs)


def test_stream_resumes_at_any_point(spark, rows, store, tmp_path):
    history = [crate("c", i % 5, i, age=i) for i in range(12)] + [crate("d", 0, 20), crate("u", 0, 15)]
    put(spark, tmp_path, *history[:4])
    put(spark, tmp_path, *history[4:9])
    sync(spark, store, tmp_path, compact_every=2)
    put(spark, tmp_path, *history[9:])
    put(spark, tmp_path, *history[:6])  # delivered again
    sync(spark, store, tmp_path, compact_every=2)
    whole = fold.current_state(project.decode_label(feed(spark, *history), CRATE), CRATE)
    assert rows(store.state("crate")) == rows(whole)
    assert store.batches() == [4] and len(store.versions("crate")) == 1  # folded and cleared


def test_failures_are_raised(spark, tmp_path, store):
    put(spark, tmp_path, crate("c", 1, 1))
    text = stream_feed(spark, str(tmp_path / "feed"))
    broken = GraphStore(spark, "nosuchfs://x", DEPOT)
    with pytest.raises((PySparkException, Py4JJavaError)):
        start_sync(text, broken, str(tmp_path / "cp"), available_now=True).awaitTermination()


def test_streaming_view(spark, rows, tmp_path):
    put(spark, tmp_path, crate("c", 1, 1), crate("c", 2, 1))
    put(spark, tmp_path, crate("u", 1, 2, age=8), crate("d", 2, 3))
    text = stream_feed(spark, str(tmp_path / "feed"), max_files_per_trigger=1).withColumn("source", F.lit("db_1"))
    view = fold.state_stream(project.label_changes(decode_envelopes(text), CRATE), CRATE)
    query = view.writeStream.format("memory").queryName("depot_view").outputMode("complete").option(
        "checkpointLocation", str(tmp_path / "view")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(fold.alive(spark.table("depot_view"), CRATE)) == [(1, "n", 8)]


def test_chunks_cover_a_table_once(spark):
    table = spark.createDataFrame([(k if k % 7 else None, k) for k in range(200)] + [(5, 900 + k) for k in range(90)], "at int, k int")
    bounds = chunk_bounds(table, "at", 40)
    assert bounds == sorted(set(bounds)) and len(bounds) >= 3
    found = [r.k for n in range(len(bounds) + 1) for r in table.where(in_chunk("at", bounds, n)).collect()]
    assert sorted(found) == sorted(r.k for r in table.collect())
    assert chunk_bounds(table.where("false"), "at", 40) == []


def at(pos):
    return {"ts_sec": 1_600_000_000, "file": "bin.1", "pos": pos}


def crates(spark, store, live, mark, **kwargs):
    table = lambda: spark.createDataFrame(list(live), "id long, name string, age int")
    home = DEPOT.label("crate")
    return ChunkedSnapshot(store, "crate", db=home.db, table=home.table, key=["id"], column="id", bounds=[10], read=table, mark=lambda: at(mark["at"]),
                           source=home.source, **kwargs)


def test_chunks_beside_changes(spark, rows, store, tmp_path):
    # Crate 1 was deleted and 2 updated (the second time unseen) before the first chunk is read; 3 is updated during the read.
    live, mark = {(2, "n", 22), (3, "n", 31), (12, "n", 12)}, {"at": 5}
    chunks = crates(spark, store, live, mark)
    put(spark, tmp_path, crate("d", 1, 3), crate("u", 2, 4, age=20), crate("u", 3, 6, age=31))
    sync(spark, store, tmp_path, chunks=chunks)
    assert rows(store.state("crate")) == [(2, "n", 22), (3, "n", 31)] and chunks.left() == [1]
    # 12 goes after the second mark, though the chunk still saw it; the chunk missed 13.
    mark["at"] = 8
    put(spark, tmp_path, crate("d", 12, 9), crate("c", 13, 10, age=13))
    sync(spark, store, tmp_path, chunks=chunks)
    assert rows(store.state("crate")) == [(13, "n", 13), (2, "n", 22), (3, "n", 31)] and chunks.left() == []


def test_a_replayed_batch_takes_its_chunk_again(spark, store):
    live, mark = {(2, "n", 2), (12, "n", 12)}, {"at": 5}
    chunks = crates(spark, store, live, mark)
    assert [r.op for r in chunks.take(1).collect()] == ["r"]
    assert chunks.left() == [0, 1]  # batch 1 is not there yet
    assert chunks.take(1).count() == 1 and chunks.dealt(1) == {0: 1}
    assert chunks.take(2).count() == 1 and chunks.dealt(2) == {0: 2}  # batch 1 never came


def test_tombstones_go_below_the_low_mark(spark, rows, tmp_path):
    store = GraphStore(spark, str(tmp_path / "marked"), DEPOT, buckets=3, keep_rejects=True)
    source = CRATE.source
    store.append(batch(spark, crate("c", 1, 1), crate("d", 1, 5), crate("c", 2, 2), crate("d", 2, 20), crate("c", 3, 3)), 1)
    store.compact("crate")
    assert store.latest("crate").count() == 3
    store.set_low_mark(source, at(4))
    store.set_low_mark(source, at(10))
    # Both sides of the mark: 1 and 4 are from before it, 2 is older than its delete, 3 and 5 are newer.
    store.append(batch(spark, crate("u", 1, 4), crate("c", 4, 9), crate("u", 2, 15), crate("u", 3, 12, age=7), crate("c", 5, 10)), 2)
    want = [(3, "n", 7), (5, "n", 1)]
    assert rows(store.state("crate")) == want
    store.compact("crate")
    assert rows(store.state("crate")) == want
    assert rows(store.latest("crate").where("_deleted").select("_vid")) == [(2,)]
    ids = spark.createDataFrame([(k,) for k in range(6)], "_vid int")
    assert rows(store.lookup("crate", ids)) == want
    assert [r.seq.pos for r in store.rejects().where("reason = 'too_late'").orderBy("seq.pos").collect()] == [4, 9]
    with pytest.raises(ValueError, match="feeds no label"):
        store.set_low_mark("nowhere", at(1))


def test_a_mark_leaves_earlier_batches_alone(spark, rows, store):
    store.append(batch(spark, crate("c", 1, 1), crate("c", 2, 2)), 1)
    store.set_low_mark(CRATE.source, at(10))
    store.append(batch(spark, crate("d", 1, 11)), 2)
    assert rows(store.state("crate")) == [(2, "n", 1)]
    store.compact("crate")
    assert rows(store.latest("crate").select("_vid", "_deleted")) == [(1, True), (2, False)]
