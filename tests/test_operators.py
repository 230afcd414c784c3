import json
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from graphtide.operators import normalize, project, route
from graphtide.plans.spec import KeyRef, Prop, VertexMap, spec_labels
from graphtide.sources.envelopes import decode_envelopes, encode_envelopes, union_sources
from graphtide.sources.label_csv import read_label_csv
from graphtide.sources.raw import decode_raw_changes
from graphtide.sources.snapshot import jdbc_options, snapshot_envelopes, snapshot_rows
from tests.samples import DEPOT, PORT, change, feed

CRATE, LASHING = DEPOT.label("crate"), DEPOT.label("lashing")
OAK = {"name": "oak", "id": 31, "age": 7}
LINK = {"inner": 8, "outer": 5, "note": "strap", "layer": 3, "weight": 4.5, "since": "2001-09-09T01:46:40",
        "place": "POINT (13.5 52.25)"}


@pytest.mark.parametrize("op, cls", [("r", route.INSERT), ("c", route.INSERT), ("u", route.UPDATE),
                                     ("d", route.DELETE)])
def test_vertex_row_per_operation(spark, rows, op, cls):
    changes = decode_envelopes(feed(spark, change(op, "crate", OAK)))
    for wanted in (route.INSERT, route.UPDATE, route.DELETE):
        slots = project.project_slots(route.route_table(changes, CRATE, wanted), CRATE)
        assert slots.columns[:3] == ["id", "name", "age"]
        assert rows(slots.select("id", "name", "age")) == ([(31, "oak", 7)] if wanted == cls else [])


def test_edge_row(spark, rows):
    changes = decode_envelopes(feed(spark, change("c", "lashing", LINK)))
    slots = project.project_slots(changes, LASHING).drop("_op", "_seq", "_bad")
    want = (8, 5, "strap", 3, Decimal("4.5"), "2001-09-09T01:46:40", "POINT (13.5 52.25)")
    assert rows(slots) == [want]
    edges = project.to_edges(changes, LASHING)
    assert edges.columns == ["_src", "_dst", "_rank", "note", "level", "weight", "since", "place", "_op", "_seq"]
    assert rows(edges.select("_src", "_dst", "_rank", "level")) == [(8, 5, 3, 3)]


@pytest.mark.parametrize("op", ["", "|", "t", "x", None, "r|c", "C"])
def test_other_operations_reach_no_label(spark, rows, op):
    changes = decode_envelopes(feed(spark, change(op, "crate", OAK)))
    assert rows(route.fan_out(changes, DEPOT)) == []
    assert rows(route.rejects(changes, DEPOT).select("reason")) == [("bad_op",)]


def test_other_tables_and_sources(spark, rows):
    other_db = change("c", "crate", OAK, db="prod")
    changes = decode_envelopes(union_sources({
        "db_1": feed(spark, change("c", "crate", OAK), other_db).drop("source"),
        "db_2": feed(spark, change("c", "crate", OAK)).drop("source"),
    }))
    assert route.scope_feed(changes, DEPOT).count() == 1
    assert rows(route.unrouted(changes, DEPOT).select("source", "db")) == [("db_1", "prod"), ("db_2", "yard")]
    assert project.label_changes(changes, CRATE).count() == 1


def test_bad_json_and_typed_decoding(spark, rows):
    texts = ["no json", change("c", "crate", OAK), '{"op": "c", "ts_sec": "late"}']
    changes = decode_envelopes(feed(spark, *texts))
    refused = route.rejects(changes, DEPOT).select("reason", "bad_json")
    assert rows(refused) == [("bad_json", "no json"), ("bad_json", texts[2])]
    typed = project.decode_label(feed(spark, *texts), CRATE)
    assert rows(typed.select("_vid", "name", "age")) == [(31, "oak", 7)]


def test_missing_and_null_fields_are_null(spark, rows):
    texts = [change("c", "crate", {"id": 1}), change("c", "crate", {"id": 2, "name": None, "age": None}),
             change("c", "crate", {"id": 3, "name": "x", "more": [1, {"a": 2}]})]
    want = [(1, None, None), (2, None, None), (3, "x", None)]
    assert rows(project.label_changes(decode_envelopes(feed(spark, *texts)), CRATE).drop("_op", "_seq", "_bad")) == want
    assert rows(project.decode_label(feed(spark, *texts), CRATE).drop("_op", "_seq", "_bad")) == want


def test_rows_without_identity_are_set_apart(spark, rows):
    changes = decode_envelopes(feed(spark, change("c", "crate", {"name": "x"}), change("c", "crate", OAK)))
    slots = project.project_slots(changes, CRATE)
    assert project.map_columns(slots, CRATE).count() == 1
    assert rows(project.null_keys(slots, CRATE).select("name")) == [("x",)]


def test_null_rank_is_zero(spark, rows):
    data = {k: v for k, v in LINK.items() if k != "layer"}
    edges = project.label_changes(decode_envelopes(feed(spark, change("c", "lashing", data))), LASHING)
    assert rows(edges.select("_rank", "level")) == [(0, None)]


def test_key_coverage(spark, rows):
    texts = [change("c", "lashing", LINK), change("c", "lashing", LINK, key=["id"]),
             change("c", "lashing", LINK, key=None), change("c", "lashing", LINK, key=["inner", "layer"])]
    routed = route.fan_out(decode_envelopes(feed(spark, *texts)), DEPOT)
    assert routed.count() == 4  # a warning drops nothing
    assert rows(route.key_coverage_counts(routed)) == [
        ("depot.lashing", "inner", 1), ("depot.lashing", "layer", 1), ("depot.lashing", "outer", 2)]


def test_one_table_feeds_several_labels(spark, rows):
    spec = spec_labels([CRATE, replace(CRATE, name="human"), LASHING])
    changes = decode_envelopes(feed(spark, change("u", "crate", OAK), change("d", "lashing", LINK)))
    assert rows(route.fan_out(changes, spec).select("label", "op_class")) == [
        ("depot.crate", "UPDATE"), ("depot.human", "UPDATE"), ("depot.lashing", "DELETE")]


def test_routes_are_broadcast(spark, plan):
    changes = decode_envelopes(feed(spark, change("c", "crate", OAK)))
    for routed in (route.fan_out(changes, DEPOT), route.scope_feed(changes, DEPOT), route.rejects(changes, DEPOT)):
        assert "BroadcastHashJoin" in plan(routed) and "SortMergeJoin" not in plan(routed)


def test_each_record_is_parsed_once(spark, plan):
    changes = decode_envelopes(feed(spark, change("c", "crate", OAK)))
    assert plan(project.label_changes(changes, CRATE)).count("from_json") == 2  # envelope, row image
    assert plan(project.decode_label(feed(spark, change("c", "crate", OAK)), CRATE)).count("from_json") == 1


def test_encode_decode_round_trip(spark, rows):
    texts = [change("c", "crate", OAK, at=3), change("d", "lashing", LINK), change("u", "crate", {}, key=None)]
    once = decode_envelopes(feed(spark, *texts))
    again = decode_envelopes(encode_envelopes(once))
    assert rows(once) == rows(again.select(once.columns))
    flat = decode_envelopes(feed(spark, *texts), data_ddl="id: int, name: string, inner: int")
    parsed = decode_envelopes(encode_envelopes(flat), data_ddl="id: int, name: string, inner: int")
    assert rows(flat) == rows(parsed.select(flat.columns))


def test_envelope_without_order_falls_back_to_seconds(spark):
    text = '{"op":"r","ts_sec":7,"db":"yard","table":"crate","data":{"id":1}}'
    assert tuple(decode_envelopes(feed(spark, text)).first()["seq"]) == (7, "", 0, 0)


def test_numbers_are_exact(spark, rows):
    text = change("c", "crate", {"id": 1}).replace('"id": 1', '"id": 1, "big": 12345678901234567890.5, "x": 1.5')
    label = VertexMap("v", "s", "yard", "crate", (
        Prop("declared", "big", "decimal(30,2)"), Prop("x", "x")), source="db_1", id=KeyRef("id"))
    undeclared = replace(label, props=(Prop("big", "big"), Prop("x", "x")))
    for read in (project.decode_label, lambda t, x: project.label_changes(decode_envelopes(t), x)):
        got = read(feed(spark, text), label).drop("_op", "_seq", "_bad")
        assert rows(got) == [("1", Decimal("12345678901234567890.50"), "1.5")]
        assert rows(read(feed(spark, text), undeclared).drop("_op", "_seq", "_bad")) == [("1", "12345678901234567890.5", "1.5")]


# -- normalisation -------------------------------------------------------------

RAW_DDL = """i8 tinyint, i16 smallint, i32 int, i64 bigint, f32 float, f64 double, bin binary, txt string,
    flag boolean, dec decimal(5,2), day int, ms bigint, us bigint, ns bigint, zoned string, tod bigint,
    geo struct<wkb: binary, srid: int>"""
LOGICAL = {"day": "date", "ms": "timestamp", "us": "micro_timestamp", "ns": "io.debezium.time.NanoTimestamp",
           "zoned": "zoned_timestamp", "tod": "micro_time", "geo": "geometry"}


def raw(spark, op, before, after, row_ddl=RAW_DDL, key="struct<i64: bigint>"):
    ddl = (f"schema_name string, op string, key {key}, before struct<{row_ddl}>, after struct<{row_ddl}>, "
           "source_offset struct<ts_sec: bigint, file: string, pos: bigint, row: int>")
    return spark.createDataFrame([("srv.bank.record.Envelope", op, (1,), before, after, (5, "bin.8", 16610, 1))], ddl)


POINT = bytearray.fromhex("0101000000" + "000000000000f03f" + "0000000000000040")
FULL = (1, 2, 3, 4, 1.5, 2.5, bytearray(b"\x01\xff"), "x", True, Decimal("1.20"), 11574, 1000000000000,
        -1, 1000000000000000001, "2031-03-05T06:07:08Z", 29106000000, (POINT, 4326))


def test_normalize_every_type(spark):
    row = normalize.normalize_changes(raw(spark, "c", None, FULL), LOGICAL, now=9, tz="Asia/Shanghai").first()
    assert json.loads(row["data"]) == {
        "i8": 1, "i16": 2, "i32": 3, "i64": 4, "f32": 1.5, "f64": 2.5, "bin": "[1, -1]", "txt": "x", "flag": True,
        "dec": 1.2, "day": "2001-09-09", "ms": "2001-09-09T01:46:40", "us": "1969-12-31T23:59:59.999999",
        "ns": "2001-09-09T01:46:40.000000001", "zoned": "2031-03-05T14:07:08", "tod": "08:05:06",
        "geo": "POINT (1 2)"}
    assert (row["op"], row["ts_sec"], row["db"], row["table"], row["key"], row["parse_time"]) == (
        "c", 5, "bank", "record", ["i64"], 9)
    assert tuple(row["seq"]) == (5, "bin.8", 16610, 1)


def test_nulls_are_left_out(spark):
    row = normalize.normalize_changes(raw(spark, "c", None, (None,) * 17), LOGICAL).first()
    assert row["data"] == "{}"


def test_raw_numbers_on_request(spark):
    row = normalize.normalize_changes(raw(spark, "c", None, FULL), LOGICAL, temporal="raw").first()
    data = json.loads(row["data"])
    assert data["day"] == 11574 and data["us"] == -1 and data["zoned"] == "2031-03-05T06:07:08Z"


@pytest.mark.parametrize("op, want", [("d", 1), ("u", 2), ("c", 2), ("r", 2)])
def test_image_channels_operation(spark, op, want):
    df = raw(spark, op, (1,), (2,), "i64 bigint")
    assert json.loads(normalize.normalize_changes(df).first()["data"]) == {"i64": want}


def test_truncate_has_no_image_and_is_rejected(spark, rows):
    flat = normalize.normalize_changes(raw(spark, "t", None, None, "i64 bigint"))
    assert flat.first()["data"] == "{}"
    assert rows(route.rejects(flat, DEPOT).select("reason")) == [("bad_op",)]


def test_key_forms(spark, rows):
    df = spark.createDataFrame([({"a": 1, "b": 2}, None)], "m map<string, int>, s struct<x: int, y: int>")
    assert rows(df.select(F.sort_array(normalize.key_columns(df, "m")), normalize.key_columns(df, "s"),
                          normalize.key_columns(df, "none"))) == [(["a", "b"], None, None)]


def test_unknown_types_fail_at_plan_time(spark):
    with pytest.raises(TypeError, match="no envelope form"):
        normalize.normalize_changes(raw(spark, "c", None, None, "m map<string, int>"))
    with pytest.raises(ValueError, match="do not exist"):
        normalize.normalize_changes(raw(spark, "c", None, None, "i64 bigint"), {"day": "date"})
    with pytest.raises(TypeError, match="is text"):
        normalize.normalize_changes(raw(spark, "c", None, None, "i64 bigint"), {"i64": "zoned_timestamp"})


def test_key_moves_delete_the_old_key(spark, rows):
    df = raw(spark, "u", (1, 5), (2, 5), "i64 bigint, v int")
    moved = normalize.normalize_changes(df, track_key_moves=["i64"])
    assert rows(moved.select("op", "data")) == [("d", '{"i64":1,"v":5}'), ("u", '{"i64":2,"v":5}')]
    kept = raw(spark, "u", (1, 5), (1, 6), "i64 bigint, v int")
    assert rows(normalize.normalize_changes(kept, track_key_moves=["i64"]).select("op")) == [("u",)]
    assert rows(normalize.normalize_changes(df).select("op")) == [("u",)]


def test_geometry_gate(spark, rows):
    multi = bytearray.fromhex("010400000000000000")
    df = spark.createDataFrame([(1, POINT), (2, multi), (3, None), (4, bytearray(b"x"))], "id int, g binary")
    kept, refused = normalize.normalize_geometry(df, "g")
    assert rows(kept) == [(1, "POINT (1 2)"), (2, None), (3, None), (4, None)]
    assert rows(refused.select("id", "geometry_kind")) == [(2, "MultiPoint"), (4, None)]


def test_raw_json(spark, rows):
    text = json.dumps({"schema_name": "s.yard.crate.Envelope", "op": "u", "key": {"id": 4},
                       "before": {"id": 31, "name": "elm", "age": 11}, "after": OAK,
                       "source_offset": {"ts_sec": 3, "file": "f", "pos": 1, "row": 0}})
    raw_changes = decode_raw_changes(feed(spark, text), "id int, name string, age int", "id int")
    depot = project.label_changes(normalize.normalize_changes(raw_changes, as_text=False), CRATE)
    assert rows(depot.drop("_seq")) == [(31, "oak", 7, "u")]


def test_parse_time_is_now(spark):
    import time

    stamp = spark.range(1).select(normalize.parse_time()).first()[0]
    assert abs(stamp - time.time()) < 60


# -- snapshots and files -------------------------------------------------------


def test_snapshot_rows_and_envelopes_agree(spark, rows):
    table = spark.createDataFrame([(1, "a", 20), (2, None, None), (None, "x", 1)], "id int, name string, age int")
    direct = snapshot_rows(table, CRATE)
    flat = snapshot_envelopes(table, "yard", "crate", ["id"]).withColumn("source", F.lit("db_1"))
    assert rows(direct) == rows(project.label_changes(flat, CRATE))
    assert rows(direct.select("_vid", "_op")) == [(1, "r"), (2, "r")]


def test_jdbc_options():
    label = PORT.label("lease")
    options = jdbc_options(label, "jdbc:x", split_column="opened", lower=1990, upper=2020, partitions=8,
                           credentials={"user": "u"})
    assert options["dbtable"] == "(SELECT `berthno`, `harbourno`, `opened`, `closed` FROM `yard`.`lease`) snapshot"
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("opened", "8", "u")
    with pytest.raises(ValueError, match="bound"):
        jdbc_options(label, "jdbc:x", split_column="opened")
    with pytest.raises(ValueError, match="not a mapped column"):
        jdbc_options(label, "jdbc:x", split_column="height", lower=0, upper=1)


def test_label_csv_with_byte_order_mark(spark, rows, tmp_path):
    path = tmp_path / "lease.csv"
    path.write_bytes("﻿p1,t1,1999,2018\np1,t2,2018,2019\n".encode())
    df = read_label_csv(spark, str(path), "berthno string, harbourno string, opened int, closed int")
    assert rows(df) == [("p1", "t1", 1999, 2018), ("p1", "t2", 2018, 2019)]
