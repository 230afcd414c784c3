"""The registered queries: every operator at work on the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtide.functions import geometry, render
from graphtide.operators import fold, normalize, project, route, verify
from graphtide.plans import feeds
from graphtide.plans.spec import DST, OP, SEQ, SRC, VID, KeyRef, Prop, VertexMap, spec_labels
from graphtide.sources.envelopes import decode_envelopes, stream_feed, union_sources, write_feed
from graphtide.sources.label_csv import read_label_csv, write_label_csv
from graphtide.sources.snapshot import snapshot_envelopes, snapshot_rows
from graphtide.streaming.chunks import ChunkedSnapshot, chunk_bounds
from graphtide.streaming.files import join, shared_dir
from graphtide.streaming.store import GraphStore
from graphtide.streaming.sync import bootstrap, start_sync, sync_available
from graphtide.streaming.view import StateView, view_available
from graphtide.streaming.watch import Warnings

Query = Callable[[SparkSession, str], DataFrame]
NOW = 1_700_000_000
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def _decoded(feed: DataFrame) -> DataFrame:
    return decode_envelopes(feeds.text(feed))


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    return decode_envelopes(feeds.mixed_text(spark, sf))


def _user_rows(spark: SparkSession, sf: str) -> DataFrame:
    return project.decode_label(feeds.text(feeds.users(spark, sf)), feeds.USER)


def _customer_rows(spark: SparkSession, sf: str) -> DataFrame:
    snapshot = snapshot_rows(feeds.table(spark, sf, "customer"), feeds.CUSTOMER)
    tail = project.decode_label(feeds.text(feeds.customer_tail(spark, sf)), feeds.CUSTOMER)
    return fold.bootstrap_then_tail(snapshot, tail)


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    return fold.current_state(project.decode_label(feeds.text(feeds.orders(spark, sf)), feeds.PLACED), feeds.PLACED)


# -- sources and sinks ---------------------------------------------------------


@query
def bootstrap_state(spark, sf):
    return fold.current_state(_customer_rows(spark, sf), feeds.CUSTOMER)


@query
def scope_feed(spark, sf):
    scoped = route.scope_feed(_mixed(spark, sf), feeds.SHOP)
    return scoped.groupBy("db", "table", "op").agg(
        F.count(F.lit(1)).alias("changes"), F.min("ts_sec").alias("first_sec"), F.max("ts_sec").alias("last_sec")
    )


@query
def multi_source_route(spark, sf):
    orders = feeds.text(feeds.orders(spark, sf))
    customers = feeds.text(feeds.customer_tail(spark, sf))
    users = feeds.text(feeds.users(spark, sf))
    # Both sources have a table shop.orders; each label reads that of its own source.
    feed = union_sources({"sales": orders, "crm": users.unionByName(customers).unionByName(orders)})
    spec = spec_labels(
        [replace(feeds.ORDER, source="sales"), replace(feeds.PLACED, source="sales"),
         replace(feeds.USER, source="crm"), replace(feeds.CUSTOMER, source="crm")],
        ["sales", "crm"],
    )
    routed = route.fan_out(decode_envelopes(feed), spec)
    return routed.groupBy("source", "label", "op_class").agg(F.count(F.lit(1)).alias("changes"))


@query
def envelope_decode(spark, sf):
    decoded = _decoded(feeds.users(spark, sf))
    return decoded.select(
        "op", "ts_sec", "db", "table", F.array_join("key", ",").alias("key"), "envelope", "parse_time",
        F.col("seq.pos").alias("pos"), F.col("seq.row").alias("row"),
    )


@query
def envelope_encode(spark, sf):
    feed = feeds.orders(spark, sf)
    # A null field leaves no trace in the text.
    data = F.col("data").withField("o_orderpriority", F.expr("nullif(data.o_orderpriority, '5-LOW')"))
    return feeds.text(feed.withColumn("data", data))


@query
def label_csv(spark, sf):
    path = join(shared_dir(spark, "label-csv"), "customer")
    rows = feeds.table(spark, sf, "customer")
    write_label_csv(rows.select("c_custkey", "c_nationkey", "c_name", "c_acctbal"), path)
    return read_label_csv(spark, path, f"{VID} bigint, nation int, name string, balance double")


@query
def snapshot_fan_out(spark, sf):
    orders = feeds.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    feed = snapshot_envelopes(orders, feeds.DB, "orders", ["o_orderkey"])
    vertices = project.label_changes(feed, feeds.ORDER)
    edges = project.label_changes(feed, feeds.PLACED)
    left = vertices.groupBy("placed_on").agg(F.count(F.lit(1)).alias("orders"), F.max(VID).alias("last_order"))
    right = edges.groupBy("placed_on").agg(F.count(F.lit(1)).alias("edges"), F.max(SRC).alias("last_customer"))
    return left.join(right, "placed_on")


# -- normalisation -------------------------------------------------------------


@query
def normalize_changes(spark, sf):
    flat = normalize.normalize_changes(feeds.raw_orders(spark, sf), {"o_orderdate": "date"}, now=NOW)
    return flat.select(
        "op", "ts_sec", "db", "table", "data", F.array_join("key", ",").alias("key"), "parse_time",
        F.col("seq.file").alias("file"), F.col("seq.pos").alias("pos"),
    )


@query
def image_select(spark, sf):
    raw = feeds.raw_orders(spark, sf)
    image = normalize.pick_image(F.col("op"), F.col("before"), F.col("after"))
    return raw.select("op", image["o_orderkey"].alias("o_orderkey"), image["o_totalprice"].alias("price"))


@query
def origin_split(spark, sf):
    events = feeds.table(spark, sf, "events")
    name = F.concat(F.lit("srv.shop_"), F.length("event_type").cast("string"), F.lit("."), "event_type",
                    F.lit(".Envelope"))
    db, table = normalize.split_origin(name)
    return events.select("event_id", db.alias("db"), table.alias("table"))


@query
def key_columns(spark, sf):
    lines = feeds.table(spark, sf, "lineitem").select(
        F.lit("contains").alias("table"), F.struct("l_orderkey", "l_partkey", "l_linenumber").alias("key"))
    parts = feeds.table(spark, sf, "part").select(
        F.lit("part").alias("table"), F.create_map(F.lit("p_partkey"), "p_partkey").alias("key"))
    events = feeds.table(spark, sf, "events").select(F.lit("keyless").alias("table"))
    named = [df.select("table", normalize.key_columns(df).alias("key")) for df in (lines, parts, events)]
    listed = reduce(DataFrame.unionByName, named).withColumn("key", F.array_join("key", ","))
    return listed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("changes"))


@query
def render_ints(spark, sf):
    parts = feeds.table(spark, sf, "part")
    image = F.struct(
        F.col("p_size").cast("tinyint").alias("int8"), F.col("p_size").cast("smallint").alias("int16"),
        F.col("p_size").alias("int32"), F.col("p_partkey").alias("int64"),
        F.col("p_retailprice").cast("float").alias("float32"), F.col("p_retailprice").alias("float64"),
        (F.col("p_size") > 25).alias("large"), F.col("p_retailprice").cast("decimal(12,2)").alias("exact"),
        F.col("p_name").alias("name"),
    )
    raw = _inserted(parts, image, "part", F.col("p_partkey"))
    label = VertexMap(
        "part", "shop", "shop", "part",
        tuple(Prop(n, n, t) for n, t in (
            ("int8", "tinyint"), ("int16", "smallint"), ("int32", "int"), ("float32", "float"),
            ("float64", "double"), ("large", "boolean"), ("exact", "decimal(12,2)"), ("name", "string"))),
        id=KeyRef("int64", "bigint"),
    )
    slots = project.project_slots(normalize.normalize_changes(raw, now=NOW), label)
    return slots.select("int8", "int16", "int32", "int64", F.col("float32").cast("double").alias("float32"),
                        "float64", "large", F.col("exact").cast("string").alias("exact"), "name")


def _inserted(rows: DataFrame, image, name: str, pos) -> DataFrame:
    """Rows as raw insert records."""
    return rows.select(
        F.lit(f"srv.shop.{name}.Envelope").alias("schema_name"), F.lit("c").alias("op"),
        F.lit(None).alias("key"), image.alias("after"), F.lit(None).cast("void").alias("before"),
        F.struct(F.lit(0).cast("bigint").alias("ts_sec"), F.lit("").alias("file"), pos.alias("pos"),
                 F.lit(0).alias("row")).alias("source_offset"),
    )


@query
def render_bytes(spark, sf):
    docs = feeds.source_rows(spark, sf, "documents", "doc_id", "text")
    rendered = render.signed_bytes(F.encode("text", "UTF-8"))
    return docs.select("doc_id", F.md5(rendered).alias("digest"), F.length(rendered).alias("chars"))


@query
def render_dates(spark, sf):
    orders = feeds.table(spark, sf, "orders")
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    return orders.select("o_orderkey", render.iso_date(day).alias("placed_on"),
                         render.iso_date(day - 20_000).alias("long_ago"))


@query
def render_timestamps(spark, sf):
    events = feeds.source_rows(spark, sf, "events", "*")
    micros = feeds.epoch_micros(F.col("ts"))
    return events.select(
        "event_id",
        render.iso_epoch(render.floor_div(micros, 1000), 10**3).alias("millis"),
        render.iso_epoch(micros, 10**6).alias("micros"),
        render.iso_epoch(micros * 1000 + F.col("user_id") % 1000, 10**9).alias("nanos"),
        render.iso_epoch(micros - 2_000_000_000_000_000, 10**6).alias("before_1970"),
        render.iso_epoch(render.floor_div(micros, 60_000_000) * 60, 1).alias("minutes"),
    )


@query
def render_zoned(spark, sf):
    events = feeds.source_rows(spark, sf, "events", "*")
    instant = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return events.select("event_id", render.iso_zoned(instant, "UTC").alias("utc"),
                         render.iso_zoned(instant, "Asia/Shanghai").alias("shanghai"))


@query
def render_time(spark, sf):
    events = feeds.source_rows(spark, sf, "events", "*")
    micros = F.pmod(feeds.epoch_micros(F.col("ts")), F.lit(86_400_000_000))
    millis = render.floor_div(micros, 1000).cast("int")
    return events.select(
        "event_id",
        render.clock_time(micros, 10**6).alias("of_micros"),
        render.clock_time(micros * 1000, 10**9).alias("of_nanos"),
        render.clock_time(millis, 10**3).alias("of_millis"),
        render.clock_time(micros, 10**6, "hh:mm:ss").alias("half_day"),
    )


@query
def geometry_gate(spark, sf):
    shapes = feeds.customer_shapes(spark, sf)
    kept, _ = normalize.normalize_geometry(shapes, "shape")
    return kept


@query
def geometry_refused(spark, sf):
    _, refused = normalize.normalize_geometry(feeds.customer_shapes(spark, sf), "shape")
    return refused.select("c_custkey", "geometry_kind")


@query
def geometry_kinds(spark, sf):
    shapes = feeds.customer_shapes(spark, sf)
    return shapes.groupBy(geometry.wkb_kind(F.col("shape")).alias("kind")).agg(F.count(F.lit(1)).alias("shapes"))


@query
def null_absent(spark, sf):
    orders = feeds.table(spark, sf, "orders")
    priority = F.col("o_orderpriority")
    field = (
        F.when(priority == "5-LOW", "").when(priority == "1-URGENT", ',"o_orderpriority":null')
        .otherwise(F.concat(F.lit(',"o_orderpriority":"'), priority, F.lit('"')))
    )
    value = F.concat(
        F.lit('{"op":"c","db":"shop","table":"orders","ts_sec":0,"data":{"o_orderkey":'),
        F.col("o_orderkey").cast("string"), field, F.lit("}}"),
    )
    rows = project.label_changes(decode_envelopes(orders.select(value.alias("value"))), feeds.ORDER)
    return rows.select(VID, "priority", "status")


# -- routing -------------------------------------------------------------------


def _routed_lines(spark, sf, op):
    feed = _decoded(feeds.contains(spark, sf))
    rows = project.to_edges(route.route_table(feed, feeds.CONTAINS, op), feeds.CONTAINS)
    return rows.drop(SEQ)


@query
def route_insert(spark, sf):
    return _routed_lines(spark, sf, route.INSERT)


@query
def route_update(spark, sf):
    return _routed_lines(spark, sf, route.UPDATE)


@query
def route_delete(spark, sf):
    return _routed_lines(spark, sf, route.DELETE)


@query
def route_table(spark, sf):
    routed = route.route_table(_mixed(spark, sf), feeds.USER)
    return routed.select("op", "ts_sec", F.col("seq.pos").alias("pos"), "envelope")


@query
def fan_out(spark, sf):
    routed = route.fan_out(_mixed(spark, sf), feeds.ALL_LABELS)
    return routed.groupBy("label", "kind", "op_class").agg(
        F.count(F.lit(1)).alias("changes"), F.max("ts_sec").alias("last_sec")
    )


@query
def key_coverage(spark, sf):
    return route.key_coverage_counts(route.fan_out(_mixed(spark, sf), feeds.ALL_LABELS))


@query
def unrouted(spark, sf):
    left_over = route.unrouted(_mixed(spark, sf), feeds.SHOP)
    return left_over.select("db", "table", "op", "ts_sec", F.col("seq.pos").alias("pos"))


@query
def rejected_changes(spark, sf):
    truncated = feeds.text(feeds.orders(spark, sf).withColumn("op", F.lit("t")))
    junk = feeds.table(spark, sf, "pages").select(F.col("url").alias("value"))
    feed = feeds.mixed_text(spark, sf).unionByName(truncated).unionByName(junk)
    refused = route.rejects(decode_envelopes(feed), feeds.SHOP)
    return refused.groupBy("reason", "table").agg(F.count(F.lit(1)).alias("changes"))


# -- projection ----------------------------------------------------------------


@query
def project_slots(spark, sf):
    changes = route.route_table(_decoded(feeds.contains(spark, sf)), feeds.CONTAINS)
    slots = project.project_slots(changes, feeds.CONTAINS)
    return slots.withColumn("ts_sec", F.col(f"{SEQ}.ts_sec")).drop(SEQ, project.BAD)


@query
def vertex_rows(spark, sf):
    return project.label_changes(_decoded(feeds.orders(spark, sf)), feeds.ORDER).drop(SEQ)


@query
def edge_rows(spark, sf):
    return project.label_changes(_decoded(feeds.orders(spark, sf)), feeds.PLACED).drop(SEQ)


@query
def edge_rows_rank(spark, sf):
    return project.label_changes(_decoded(feeds.contains(spark, sf)), feeds.CONTAINS).drop(SEQ)


# -- change application --------------------------------------------------------


@query
def vertex_state(spark, sf):
    return fold.current_state(_user_rows(spark, sf), feeds.USER)


@query
def edge_state(spark, sf):
    rows = project.label_changes(_decoded(feeds.contains(spark, sf)), feeds.CONTAINS_UNRANKED)
    return fold.current_state(rows, feeds.CONTAINS_UNRANKED)


@query
def edge_state_rank(spark, sf):
    rows = project.decode_label(feeds.text(feeds.contains(spark, sf)), feeds.CONTAINS)
    return fold.current_state(rows, feeds.CONTAINS)


@query
def deleted_keys(spark, sf):
    user = feeds.USER.bare()
    return fold.deleted_keys(project.decode_label(feeds.text(feeds.users(spark, sf)), user), user)


@query
def late_change(spark, sf):
    """Every change delivered twice, in an order that has nothing to do with time."""
    feed = feeds.text(feeds.users(spark, sf))
    shuffled = feed.unionByName(feed).hint("rebalance")
    rows = project.label_changes(decode_envelopes(shuffled), feeds.USER)
    return fold.current_state(rows, feeds.USER)


@query
def key_moves(spark, sf):
    """An order that changes hands leaves no edge at its old customer."""
    label = replace(feeds.PLACED, props=(Prop("total", "o_totalprice", "double"),))
    raw = feeds.raw_moves(spark, sf)
    # The old edges exist first: they are what an open order moves away from.
    before = raw.withColumn("op", F.lit("c")).withColumn("after", F.col("before")).withColumn(
        "source_offset", F.col("source_offset").withField("ts_sec", F.lit(0).cast("bigint")))
    moves = normalize.normalize_changes(raw, now=NOW, track_key_moves=label.index_columns, as_text=False)
    first = normalize.normalize_changes(before, now=NOW, as_text=False)
    return fold.current_state(project.label_changes(first.unionByName(moves), label), label)


@query
def merged_state(spark, sf):
    """Snapshot and tail folded on their own, then merged."""
    label = feeds.CUSTOMER
    base = fold.latest_changes(snapshot_rows(feeds.table(spark, sf, "customer"), label), label)
    tail_rows = project.label_changes(_decoded(feeds.customer_tail(spark, sf)), label)
    return fold.alive(fold.merge_latest(base, fold.latest_changes(tail_rows, label), label), label)


# -- read-back -----------------------------------------------------------------


@query
def vertex_lookup(spark, sf):
    ids = feeds.table(spark, sf, "supplier").select(F.col("s_suppkey").alias(VID))
    return verify.lookup_vertices(fold.current_state(_user_rows(spark, sf), feeds.USER), ids)


@query
def edge_fetch(spark, sf):
    wanted = feeds.table(spark, sf, "orders").where("o_orderstatus = 'O'")
    pairs = wanted.select(F.col("o_custkey").alias(SRC), F.col("o_orderkey").alias(DST))
    return verify.fetch_edges(_placed(spark, sf), pairs)


@query
def one_hop(spark, sf):
    placed = feeds.PLACED.bare()
    edges = fold.current_state(project.decode_label(feeds.text(feeds.orders(spark, sf)), placed), placed)
    seeds = feeds.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return verify.one_hop(edges, seeds.select(F.col("c_custkey").alias(SRC)))


@query
def one_hop_heavy(spark, sf):
    """One hop where source 0 owns half of all edges: found by a sketch, spread on its own."""
    lines = feeds.table(spark, sf, "lineitem")
    source = F.when(F.col("l_orderkey") % 2 == 0, 0).otherwise(F.col("l_orderkey")).cast("bigint")
    edges = lines.select(source.alias(SRC), F.col("l_partkey").alias(DST), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_rank"))
    pending = feeds.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias(SRC))
    seeds = pending.unionByName(spark.range(1).select(F.col("id").alias(SRC)))
    return verify.one_hop(edges, seeds, heavy=verify.heavy_keys(edges))


@query
def graph_stats(spark, sf):
    """A mixed feed logged once for all its labels, then counted label by label."""
    labels = [feeds.USER, feeds.CUSTOMER, feeds.ORDER, feeds.PLACED, feeds.CONTAINS]
    store = GraphStore(spark, join(shared_dir(spark, "stats"), "store"), spec_labels(labels))
    store.append(_mixed(spark, sf), 0)
    return store.stats()


@query
def store_edges(spark, sf):
    """Edges without a rank: two folds of a version and a newer tail."""
    store = GraphStore(spark, join(shared_dir(spark, "edges"), "store"), spec_labels([feeds.CONTAINS_UNRANKED]))
    changes = _decoded(feeds.contains(spark, sf))
    for number in range(3):
        store.append(changes.where(F.pmod("seq.pos", F.lit(3)) == number), number + 1)
        if number < 2:
            store.compact(feeds.CONTAINS_UNRANKED)
    return store.state(feeds.CONTAINS_UNRANKED)


def _placed_store(spark, sf, purpose: str) -> GraphStore:
    """Orders as edges, half of them folded."""
    store = GraphStore(spark, join(shared_dir(spark, purpose), "store"), spec_labels([feeds.PLACED]))
    changes = _decoded(feeds.orders(spark, sf))
    store.append(changes.where("seq.pos % 2 = 0"), 1)
    store.compact(feeds.PLACED)
    store.append(changes.where("seq.pos % 2 = 1"), 2)
    return store


@query
def store_fetch(spark, sf):
    """Edges between given ends, from a version and newer changes."""
    asked = feeds.table(spark, sf, "orders").where("o_orderstatus = 'O'")
    pairs = asked.select(F.col("o_custkey").alias(SRC), F.col("o_orderkey").alias(DST))
    return _placed_store(spark, sf, "fetch").fetch(feeds.PLACED, pairs)


@query
def store_one_hop(spark, sf):
    """Orders of the customers of a segment, from a version and newer changes."""
    seeds = feeds.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias(SRC))
    return _placed_store(spark, sf, "one-hop").one_hop(feeds.PLACED, seeds)


@query
def key_moves_vertex(spark, sf):
    """The moves of ``key_moves`` seen by a vertex that keeps its key: no order disappears."""
    label = replace(feeds.ORDER, props=(Prop("total", "o_totalprice", "double"),))
    moves = normalize.normalize_changes(feeds.raw_moves(spark, sf), now=NOW, track_key_moves=feeds.PLACED.index_columns, as_text=False)
    return fold.current_state(project.label_changes(moves, label), label)


@query
def rejected_values(spark, sf):
    """Changes whose values do not fit the mapping: a name declared a number, an id that is missing."""
    label = replace(feeds.CUSTOMER, props=(Prop("name", "c_name", "int"),))
    tail = feeds.customer_tail(spark, sf)
    nameless = tail.withColumn("data", F.col("data").withField("c_custkey", F.expr("nullif(data.c_nationkey, 3) + data.c_custkey")))
    slots = project.project_slots(route.route_table(_decoded(nameless), label), label)
    found = project.rejected_slots(slots, label)
    return found.groupBy("reason", F.col(OP).alias("op")).agg(F.count(F.lit(1)).alias("changes"))


@query
def normalize_mixed(spark, sf):
    """Raw change text of two tables through one decoder."""
    customers = feeds.table(spark, sf, "customer").select(
        F.lit("srv.shop.customer.Envelope").alias("schema_name"), F.lit("c").alias("op"), F.struct("c_custkey").alias("key"),
        F.struct("c_custkey", "c_name", "c_nationkey").alias("after"),
        F.struct(F.lit(5).cast("bigint").alias("ts_sec"), F.lit("bin.000001").alias("file"), F.col("c_custkey").alias("pos"), F.lit(0).alias("row")).alias("source_offset"))
    text = [df.select(F.to_json(F.struct("*")).alias("value")) for df in (feeds.raw_orders(spark, sf), customers)]
    flat = normalize.normalize_feed(text[0].unionByName(text[1]), {
        "shop.orders": normalize.RawTable("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate int, o_orderpriority string", "o_orderkey bigint", {"o_orderdate": "date"}),
        "shop.customer": normalize.RawTable("c_custkey bigint, c_name string, c_nationkey int", "c_custkey bigint"),
    }, now=NOW)
    field = lambda name: F.get_json_object("data", f"$.{name}")
    return flat.groupBy("db", "table", "op", F.array_join("key", ",").alias("key")).agg(
        F.count("data").alias("changes"), F.sum(F.coalesce(field("o_custkey"), field("c_nationkey")).cast("bigint")).alias("total"),
        F.min(F.coalesce(field("o_orderdate"), field("c_name"))).alias("least"), F.max("seq.pos").alias("last"))


@query
def snapshot_tail_render(spark, sf):
    """Undeclared columns read alike from a snapshot, from its envelopes and from changes: one text for each row."""
    table = feeds.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("at"), F.col("o_orderdate").cast("date").alias("day"),
        F.encode(F.substring("o_orderpriority", 1, 2), "UTF-8").alias("bytes"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    label = VertexMap("seen", feeds.SPACE, feeds.DB, "orders", tuple(Prop(c, c) for c in ("at", "day", "bytes", "price")), id=KeyRef("o_orderkey", "bigint"))
    raw = table.select(
        F.lit("srv.shop.orders.Envelope").alias("schema_name"), F.lit("c").alias("op"), F.struct("o_orderkey").alias("key"),
        F.lit(None).cast(table.schema).alias("before"), F.struct("*").alias("after"),
        F.struct(F.lit(1).cast("bigint").alias("ts_sec"), F.lit("").alias("file"), F.lit(0).cast("bigint").alias("pos"), F.lit(0).alias("row")).alias("source_offset"))
    ways = [
        snapshot_rows(table, label),
        project.label_changes(snapshot_envelopes(table, feeds.DB, "orders", ["o_orderkey"]), label),
        project.label_changes(normalize.normalize_changes(raw, now=NOW), label),
    ]
    text = F.concat_ws("|", "at", "day", "bytes", "price").alias("text")
    return reduce(DataFrame.unionByName, [w.select(VID, text) for w in ways]).distinct()


def _in_credit(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in credit, as the graph has them."""
    return feeds.table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias(VID), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )


@query
def reconcile(spark, sf):
    """Customers in credit against the graph: some changed, some gone, some never in credit."""
    graph = fold.current_state(_customer_rows(spark, sf), feeds.CUSTOMER)
    found = verify.reconcile(_in_credit(spark, sf), graph, [VID])
    return found.withColumn("columns", F.array_join("columns", ","))


@query
def reconcile_ranges(spark, sf):
    """The same by checksums of key ranges, against a stored graph."""
    path = shared_dir(spark, "reconcile")
    fold.current_state(_customer_rows(spark, sf), feeds.CUSTOMER).write.parquet(path)
    found = verify.reconcile_ranges(_in_credit(spark, sf), spark.read.parquet(path), [VID])
    return found.withColumn("columns", F.array_join("columns", ","))


# -- streaming -----------------------------------------------------------------


@query
def stream_vertex_state(spark, sf):
    """Envelope files as a stream into a store, read back as vertices."""
    home = shared_dir(spark, "stream")
    write_feed(feeds.text(feeds.users(spark, sf)), join(home, "feed"))
    store = GraphStore(spark, join(home, "store"), feeds.SHOP)
    files = max(1, spark.sparkContext.defaultParallelism // 2)
    stream = stream_feed(spark, join(home, "feed"), max_files_per_trigger=files)
    sync_available(stream, store, join(home, "checkpoint"))
    return store.state(feeds.USER)


@query
def stream_resume(spark, sf):
    """Two runs on one checkpoint with new files, a folded version and a replayed batch in between."""
    home = shared_dir(spark, "resume")
    feed, checkpoint = join(home, "feed"), join(home, "checkpoint")
    changes = feeds.contains(spark, sf)
    store = GraphStore(spark, join(home, "store"), feeds.SHOP)
    finished = F.col("data.l_linestatus") == "F"
    write_feed(feeds.text(changes.where(finished)), feed)
    sync_available(stream_feed(spark, feed), store, checkpoint)
    store.compact(feeds.CONTAINS)
    write_feed(feeds.text(changes.where(~finished)), feed)
    sync_available(stream_feed(spark, feed), store, checkpoint)
    store.append(decode_envelopes(spark.read.text(feed)), store.batches()[-1] + 1)
    return store.state(feeds.CONTAINS)


@query
def store_bootstrap(spark, sf):
    """Snapshot loaded as the first version, then the tail folded into it."""
    home = shared_dir(spark, "bootstrap")
    store = GraphStore(spark, join(home, "store"), feeds.ALL_LABELS)
    store.load_snapshot(feeds.CUSTOMER, feeds.table(spark, sf, "customer"))
    store.append(_decoded(feeds.customer_tail(spark, sf)), 1)
    store.compact(feeds.CUSTOMER)
    return store.state(feeds.CUSTOMER)


@query
def store_lookup(spark, sf):
    """Lookups that fold only the requested keys, from a version and newer changes."""
    home = shared_dir(spark, "lookup")
    store = GraphStore(spark, join(home, "store"), feeds.ALL_LABELS)
    customers = feeds.table(spark, sf, "customer")
    bootstrap(store, snapshot_envelopes(customers, feeds.DB, "customer", ["c_custkey"]))
    store.compact(feeds.CUSTOMER)
    store.append(_decoded(feeds.customer_tail(spark, sf)), 1)
    ids = feeds.table(spark, sf, "supplier").select(F.col("s_suppkey").alias(VID))
    return store.lookup(feeds.CUSTOMER, ids)


@query
def state_view(spark, sf):
    """Users kept in the state store: half of the changes, a restart from the checkpoint, the other half."""
    home = shared_dir(spark, "view")
    feed, changes = join(home, "feed"), feeds.users(spark, sf)
    for half in range(2):
        write_feed(feeds.text(changes.where(F.pmod("seq.pos", F.lit(2)) == half)), feed)
        view_available(stream_feed(spark, feed), StateView(spark, join(home, "checkpoint"), feeds.SHOP, feeds.USER))
    return StateView(spark, join(home, "checkpoint"), feeds.SHOP, feeds.USER).state()


@query
def stream_key_coverage(spark, sf):
    """Key warnings of a running sync, over two batches of a mixed feed."""
    home = shared_dir(spark, "watch")
    feed, text = join(home, "feed"), feeds.encoded_once(feeds.mixed_text(spark, sf))
    store = GraphStore(spark, join(home, "store"), feeds.ALL_LABELS)
    watch = Warnings(feeds.ALL_LABELS)
    for half in range(2):
        write_feed(text.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half), feed)
        run = start_sync(stream_feed(spark, feed), store, join(home, "checkpoint"), available_now=True, watch=watch)
        run.awaitTermination()
        watch.settle(run)
    watch.unregister(spark)
    return watch.missing(spark)


@query
def raw_to_reconcile(spark, sf):
    """The whole way: raw change text, normalised in a stream, stored, folded, and held against the source table."""
    home = shared_dir(spark, "end-to-end")
    feed, raw = join(home, "feed"), feeds.raw_orders(spark, sf)
    label = replace(feeds.ORDER, props=tuple(p for p in feeds.ORDER.props if p.column != "o_orderstatus"))
    store = GraphStore(spark, join(home, "store"), spec_labels([label]))
    described = normalize.RawTable("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate int, o_orderpriority string", "o_orderkey bigint", {"o_orderdate": "date"})
    for half in range(2):
        part = raw.where(F.pmod("source_offset.pos", F.lit(2)) == half)
        write_feed(part.select(F.to_json(F.struct("*")).alias("value")), feed)
        sync_available(stream_feed(spark, feed), store, join(home, "checkpoint"), decode=partial(normalize.normalize_feed, tables={"shop.orders": described}, now=NOW))
        if half == 0:
            store.compact(label)
    source = feeds.table(spark, sf, "orders").where("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias(VID), F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("total"),
        F.col("o_orderdate").cast("date").cast("string").alias("placed_on"), F.col("o_orderpriority").alias("priority"))
    found = verify.reconcile(source, store.state(label), [VID])
    return found.withColumn("columns", F.array_join("columns", ","))


@query
def chunked_bootstrap(spark, sf):
    """Customers read in chunks beside their changes: each chunk sees some changes that the stream brings too.

    Changes are cut into four runs by time.  With run k the table is read as it was after
    run k + 1, one chunk of it, at the mark where run k ends.
    """
    home, runs = shared_dir(spark, "chunks"), 4
    feed, tail = join(home, "feed"), feeds.customer_tail(spark, sf)
    customers, label = feeds.table(spark, sf, "customer"), feeds.CUSTOMER
    ends = tail.agg(F.percentile_approx("ts_sec", [k / runs for k in range(1, runs)])).head()[0] or [0] * (runs - 1)
    ends = [*ends, 1 << 40]
    first = snapshot_rows(customers, label)
    changes = project.label_changes(tail.withColumn("data", F.to_json("data")), label)
    store = GraphStore(spark, join(home, "store"), spec_labels([label]))
    now = {}

    def read():
        seen = changes.where(F.col(f"{SEQ}.ts_sec") <= ends[min(now["run"] + 1, runs - 1)])
        rows = fold.current_state(fold.bootstrap_then_tail(first, seen), label)
        return rows.select(F.col(VID).alias("c_custkey"), *[F.col(p.name).alias(p.column) for p in label.props])

    rows = max(1, math.ceil(customers.count() / runs))
    chunks = ChunkedSnapshot(
        store, "customer", db=feeds.DB, table="customer", key=["c_custkey"], column="c_custkey", bounds=chunk_bounds(customers, "c_custkey", rows),
        read=read, mark=lambda: {"ts_sec": ends[now["run"]]})
    for run in range(runs):
        now["run"] = run
        after = ends[run - 1] if run else -(1 << 40)
        write_feed(feeds.text(tail.where((F.col("ts_sec") > after) & (F.col("ts_sec") <= ends[run]))), feed)
        sync_available(stream_feed(spark, feed), store, join(home, "checkpoint"), chunks=chunks)
    return store.state(label)
