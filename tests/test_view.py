from functools import partial

import pytest
from pyspark.sql import functions as F

from graphtide.plans.feeds import encoded_once
from graphtide.sources.envelopes import decode_envelopes, encode_envelopes, stream_feed
from graphtide.streaming.store import GraphStore
from graphtide.streaming.sync import sync_available
from graphtide.streaming.view import StateView, view_available
from graphtide.streaming.watch import ABSENT, CHANGES, UNKEYED, Warnings, _present, _Totals
from tests.samples import DEPOT, change, feed
from tests.test_operators import LINK
from tests.test_stream import batch, crate

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def arrive(spark, tmp_path):
    """Write texts as a new file of the feed; returns the feed's directory."""
    def write(*texts):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "feed"))
        return str(tmp_path / "feed")

    return write


def decoded(df):
    return decode_envelopes(df).withColumn("source", F.lit("db_1"))


def follow(spark, path, view, **kwargs):
    view_available(stream_feed(spark, path), view, decode=decoded, **kwargs)


# -- the state of a stream ---------------------------------------------------------


def test_view_goes_on_after_a_restart(spark, rows, arrive, tmp_path):
    before = spark.conf.get(PROVIDER)
    view = lambda: StateView(spark, str(tmp_path / "checkpoint"), DEPOT, "crate")
    path = arrive(crate("c", 1, 1), crate("c", 2, 1), crate("d", 3, 9))
    follow(spark, path, view())
    assert rows(view().state()) == [(1, "n", 1), (2, "n", 1)]
    arrive(crate("u", 1, 4, age=7), crate("d", 2, 5), crate("u", 3, 8), crate("c", 4, 1))
    follow(spark, path, view())
    # A late change does not bring a deleted key back, and a repeated one changes nothing.
    assert rows(view().state()) == [(1, "n", 7), (4, "n", 1)]
    arrive(crate("u", 2, 3), crate("u", 1, 2, age=3), crate("c", 4, 1), "no json", change("c", "lashing", LINK))
    follow(spark, path, view())
    assert rows(view().state()) == [(1, "n", 7), (4, "n", 1)]
    assert spark.conf.get(PROVIDER) == before


def test_deleted_keys_keep_no_properties(spark, rows, arrive, tmp_path):
    view = StateView(spark, str(tmp_path / "checkpoint"), DEPOT, "crate")
    follow(spark, arrive(crate("c", 1, 1), crate("d", 2, 1), crate("d", 3, 1)), view)
    assert rows(view.latest().where("_deleted").select("_vid", "name", "age")) == [(2, None, None), (3, None, None)]
    size = view.size()
    assert (size.keys, size.deleted) == (3, 2) and size.bytes > 0 and size.bytes_per_key == size.bytes / 3


def test_edges_and_published_changes(spark, rows, arrive, tmp_path):
    view, seen = StateView(spark, str(tmp_path / "checkpoint"), DEPOT, DEPOT.label("lashing")), []
    publish = lambda df, number: seen.append((number, sorted(tuple(r) for r in df.select("_src", "_dst", "_rank", "_deleted").collect())))
    path = arrive(change("c", "lashing", LINK, 1), change("c", "lashing", {**LINK, "layer": 9}, 1))
    follow(spark, path, view, publish=publish)
    arrive(change("d", "lashing", LINK, 2))
    follow(spark, path, view, publish=publish)
    assert rows(view.state().select("_src", "_dst", "_rank")) == [(8, 5, 9)]
    assert seen == [(0, [(8, 5, 3, False), (8, 5, 9, False)]), (1, [(8, 5, 3, True)])]


# -- warnings of a running sync ----------------------------------------------------


def sync(spark, path, tmp_path, watch, decode=decoded):
    store = GraphStore(spark, str(tmp_path / "store"), DEPOT, buckets=2)
    sync_available(stream_feed(spark, path), store, str(tmp_path / "checkpoint"), decode=decode, watch=watch)


def counted(watch):
    return {k: n for k, n in watch.counts().items() if n}


def test_warnings_add_up_over_batches_and_restarts(spark, rows, arrive, tmp_path):
    watch = Warnings(DEPOT)
    texts = [crate("c", 1, 1), change("c", "crate", {"id": 2}, 2, key=["name"]), change("u", "crate", {"id": 3, "name": None}, 3, key=[]),
             change("d", "crate", {"id": 4, "name": "n"}, 4, key=None), change("x", "crate", {}, 5, key=[]), "no json", crate("c", 9, 1).replace("yard", "other")]
    path = arrive(*texts)
    sync(spark, path, tmp_path, watch)
    arrive(change("c", "lashing", LINK, key=["inner"]), change("u", "crate", {"id": 1, "name": "m"}, 8))
    sync(spark, path, tmp_path, watch)
    _settled(spark, watch, 6)
    watch.unregister(spark)
    # A change without a key is not judged; neither is one of an unknown operation or table.
    assert rows(watch.missing(spark)) == [("depot.crate", "id", 2), ("depot.lashing", "layer", 1), ("depot.lashing", "outer", 1)]
    found = {c: n for label, c, n in rows(watch.absent(spark)) if label == "depot.crate"}
    assert found == {"name": 2, "age": 4}
    assert watch.counts()[CHANGES, "depot.crate", ""] == 5 and watch.unseen() == []


def _settled(spark, watch, changes):
    """Events come behind the query; wait for all of them."""
    import time

    for _ in range(100):
        if sum(n for (kind, _, _), n in watch.counts().items() if kind == CHANGES) >= changes:
            return
        time.sleep(0.2)


def test_columns_that_no_change_has(spark, arrive, tmp_path):
    watch = Warnings(DEPOT)
    bare = [change("c", "crate", {"id": i, "nmae": "n", "age": 1}, i) for i in range(3)]
    flat = partial(_flat, spark)
    sync(spark, arrive(*bare), tmp_path, watch, decode=flat)
    _settled(spark, watch, 3)
    watch.unregister(spark)
    assert watch.unseen() == [("depot.crate", "name")]
    assert counted(watch) == {(CHANGES, "depot.crate", ""): 3, (ABSENT, "depot.crate", "name"): 3}


def _flat(spark, df):
    """Decoded envelopes whose row image is a column of text, as ``normalize_feed`` gives them."""
    return decoded(df).withColumn("data", F.get_json_object("envelope", "$.data")).drop("envelope", "bad_json")


IMAGES = [
    ('{"id": 1, "name": null, "age": 0}', ["id", "age"]), ('{"id": 1, "id": null}', ["id"]), ('{"id": {"a": 1, "a": 2}, "age": [null]}', ["id", "age"]),
    ('{"id": 12345678901234567890123456789012345678901234567890, "ID": ""}', ["id", "ID"]), ("{}", []), ("null", None), ('"id"', None), ("[1]", None), ("3", None),
]


def test_what_an_image_has(spark):
    rows = spark.createDataFrame([(f'{{"op": "c", "data": {image}}}', image) for image, _ in IMAGES], "envelope string, data string").coalesce(1)
    for feed in (rows.drop("data"), rows.drop("envelope")):
        assert [r[0] for r in feed.select(_present(feed)).collect()] == [names for _, names in IMAGES]


def test_each_record_is_matched_with_its_table_once(spark):
    plan = Warnings(DEPOT).observe(batch(spark, crate("c", 1, 1)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" = crate)") == 1 and plan.count(" = lashing)") == 1


def test_a_filter_on_encoded_text_does_not_encode_again(spark):
    text = encode_envelopes(spark.range(3).select(F.lit("c").alias("op"), F.struct("id").alias("data")))
    kept = encoded_once(text).where(F.xxhash64("value") != 0)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("StructsToJson") == 1
    assert sorted(r["value"] for r in kept.collect()) == [f'{{"op":"c","data":{{"id":{k}}}}}' for k in range(3)]


def test_a_repeated_batch_is_counted_once():
    totals = _Totals()
    for number, n in ((0, 3), (1, 4), (1, 5), (2, 1)):
        totals.add(number, {"n0": n})
    assert totals.sum() == {"n0": 9}


def test_rows_pass_unchanged(spark, rows):
    df = decode_envelopes(feed(spark, crate("c", 1, 1), "no json"))
    assert rows(Warnings(DEPOT).observe(df)) == rows(df)
    assert {kind for kind, _, _ in Warnings(DEPOT)._names} == {CHANGES, UNKEYED, ABSENT}


# -- lookups that read a part of a version -----------------------------------------


def test_lookups_read_the_buckets_of_the_request(spark, rows, tmp_path):
    store = GraphStore(spark, str(tmp_path / "store"), DEPOT, buckets=64)
    links = [change("c", "lashing", {**LINK, "inner": i, "outer": i % 7, "layer": None}, 1) for i in range(300)]
    store.append(batch(spark, *[crate("c", i, 1) for i in range(300)], *links), 0)
    store.compact_all()
    store.append(batch(spark, crate("d", 5, 2), crate("c", 1000, 2)), 1)
    files = lambda df: len({f for f in df.inputFiles() if "/base/" in f})
    whole = files(store.state("crate"))
    read = []
    for n in (1, 4, 300):
        ids = spark.range(5, 5 + n).withColumnRenamed("id", "_vid")
        found = store.lookup("crate", ids)
        assert sorted(r[0] for r in rows(found.select("_vid"))) == [i for i in range(6, min(300, 5 + n))]
        read.append(files(found))
        assert read[-1] <= min(n, whole)
    assert read[0] == 1 < read[1] < read[2] <= whole
    assert rows(store.lookup("crate", spark.createDataFrame([(1000,), (None,), (5,)], "_vid int")).select("_vid")) == [(1000,)]
    assert store.lookup("crate", spark.createDataFrame([], "_vid int")).count() == 0


def test_tables_whose_names_join_to_the_same_place(spark, rows, tmp_path):
    from dataclasses import replace

    from graphtide.plans.spec import spec_labels

    crate_label = DEPOT.label("crate")
    one, two = replace(crate_label, db="a.b", table="c", name="one"), replace(crate_label, db="a", table="b.c", name="two")
    store = GraphStore(spark, str(tmp_path / "store"), spec_labels([one, two]))
    texts = [crate("c", 1, 1).replace('"db": "yard"', '"db": "a.b"').replace('"table": "crate"', '"table": "c"'),
             crate("c", 2, 1).replace('"db": "yard"', '"db": "a"').replace('"table": "crate"', '"table": "b.c"')]
    store.append(batch(spark, *texts), 0)
    assert rows(store.state(one).select("_vid")) == [(1,)] and rows(store.state(two).select("_vid")) == [(2,)]
