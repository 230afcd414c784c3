"""Reading a graph back: lookups, one hop, statistics and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtide.plans.spec import DST, RANK, SRC, VID, quoted

# Tasks over which the edges of a heavy key are spread, and the share of all edges that makes a key heavy.
SALTS = 16
HEAVY_SHARE = 1 / 64
TRACKED = 10_000


def lookup_vertices(vertices: DataFrame, ids: DataFrame) -> DataFrame:
    """Vertices whose ``_vid`` is among ``ids``.

    Ids are made distinct before the join; that needs the same partitioning as
    the join, so it adds no shuffle.
    """
    return vertices.join(ids.select(VID).distinct(), VID, "left_semi")


def heavy_keys(edges: DataFrame, on: Sequence[str] = (SRC,), share: float = HEAVY_SHARE) -> list[int]:
    """Hashes of the keys that own at least ``share`` of all edges.

    One pass over the key columns with a frequency sketch in each task: nothing is
    shuffled but the sketches, and at most ``2 / share`` keys come back.  Frequencies are
    off by a ``TRACKED``-th of the edges at most or so, so the bar is put half as high.
    """
    most = int(1 / share)
    keys = edges.select(F.xxhash64(*[quoted(c) for c in on]).alias("key"))
    found = keys.agg(F.count("key").alias("n"), F.expr(f"approx_top_k(key, {2 * most}, {TRACKED})").alias("top")).head()
    return [t["item"] for t in found["top"] or [] if t["count"] >= share / 2 * found["n"]]


def fetch_edges(edges: DataFrame, pairs: DataFrame, *, heavy: Sequence[int] = (), salts: int = SALTS) -> DataFrame:
    """Edges of any rank between the given ``(_src, _dst)`` pairs; ``heavy`` as in ``one_hop``."""
    return _salted_semi(edges, pairs.select(SRC, DST), [SRC, DST], F.xxhash64(RANK), heavy, salts)


def one_hop(edges: DataFrame, seeds: DataFrame, *, heavy: Sequence[int] = (), salts: int = SALTS) -> DataFrame:
    """Out-neighbours of the seeds: one ``(_src, _dst, _rank)`` row per edge.

    ``seeds`` has a column ``_src``.  The edges of ``heavy`` sources (``heavy_keys``) are
    spread over ``salts`` tasks, and only the requests for these are copied as often.
    Without them a skewed task is left to adaptive execution, which splits it.
    """
    spread = F.xxhash64(DST, RANK)
    return _salted_semi(edges.select(SRC, DST, RANK), seeds.select(SRC), [SRC], spread, heavy, salts)


def _salted_semi(edges: DataFrame, wanted: DataFrame, on: list[str], spread: Column, heavy: Sequence[int], salts: int) -> DataFrame:
    # Hashes tell types apart, so the request takes those of the edges.
    wanted = wanted.select(*[F.col(c).cast(edges.schema[c].dataType).alias(c) for c in on]).distinct()
    if not heavy or salts <= 1:
        return edges.join(wanted, on, "left_semi")
    is_heavy = F.xxhash64(*on).isin(*heavy)
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = edges.withColumn("_salt", F.when(is_heavy, F.pmod(spread, F.lit(salts)).cast("int")).otherwise(0))
    return salted.join(wanted.withColumn("_salt", F.explode(copies)), [*on, "_salt"], "left_semi").drop("_salt")


def graph_stats(vertices: Mapping[tuple[str, str], DataFrame], edges: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per tag and edge type, and the totals of each space.

    The labels are keyed by (space, name).  ``type`` is Tag, Edge or Space.  A
    vertex that carries several tags of a space counts once in its total.  Every label is read once: vertices are grouped by id,
    and each group votes for its tags and for the total.
    """
    names = [(s, "Tag", n) for s, n in vertices] + [(s, "Edge", n) for s, n in edges]
    names += [(s, "Space", what) for what, labels in (("vertices", vertices), ("edges", edges)) for s in dict.fromkeys(s for s, _ in labels)]
    if not names:
        raise ValueError("no label given")
    votes = []
    if vertices:
        tagged = _labelled(vertices, F.col(VID).cast("string").alias(VID))
        total = F.struct(F.lit("Space").alias("type"), F.lit("vertices").alias("name"))
        per_id = tagged.groupBy("space", VID).agg(F.collect_set("name").alias("tags"))
        tags = F.transform("tags", lambda t: F.struct(F.lit("Tag").alias("type"), t.alias("name")))
        votes.append(per_id.select("space", F.inline(F.array_append(tags, total))).withColumn("n", F.lit(1)))
    if edges:
        per_type = _labelled(edges).groupBy("space", "name").agg(F.count(F.lit(1)).alias("n"))
        both = F.array(
            F.struct(F.lit("Edge").alias("type"), F.col("name").alias("name")),
            F.struct(F.lit("Space").alias("type"), F.lit("edges").alias("name")),
        )
        votes.append(per_type.select("space", "n", F.inline(both)))
    counted = reduce(DataFrame.unionByName, votes).groupBy("space", "type", "name").agg(F.sum("n").alias("n"))
    # As many rows as labels: this join only adds the labels without rows.
    listed = counted.sparkSession.createDataFrame(names, "space string, type string, name string")
    return listed.join(counted, ["space", "type", "name"], "left").select(
        "space", "type", "name", F.coalesce("n", F.lit(0)).alias("count")
    )


def _labelled(frames: Mapping[tuple[str, str], DataFrame], *columns: Column) -> DataFrame:
    parts = [df.select(F.lit(space).alias("space"), F.lit(name).alias("name"), *columns) for (space, name), df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile(source: DataFrame, graph: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on which a mapped source table and a graph table disagree.

    Both have the same columns.  ``status`` is ``missing`` (only in the source),
    ``extra`` (only in the graph), ``differs`` or ``repeated`` (the source has
    the key more than once); ``columns`` lists the properties that differ.
    Values are compared as they are, null equals null.

    One shuffle: both sides are united and grouped, and the group combines
    before the shuffle, so a repeated key cannot fill a task.
    """
    keys = list(keys)
    if set(source.columns) != set(graph.columns):
        raise ValueError(f"columns differ: {source.columns} and {graph.columns}")
    props = [c for c in source.columns if c not in keys]
    row = F.struct(*[quoted(p) for p in props]) if props else F.struct(F.lit(1).alias("one"))
    both = source.select(*keys, row.alias("s"), F.lit(None).alias("g")).unionByName(
        graph.select(*keys, F.lit(None).alias("s"), row.alias("g"))
    )
    grouped = both.groupBy(*keys).agg(
        F.count("s").alias("in_source"), F.count("g").alias("in_graph"),
        F.max("s").alias("s"), F.max("g").alias("g"),
    )
    unlike = F.array_compact(F.array(*[
        F.when(~F.col("s").getField(p).eqNullSafe(F.col("g").getField(p)), F.lit(p)) for p in props
    ])) if props else F.array().cast("array<string>")
    status = (
        F.when(F.col("in_graph") == 0, "missing")
        .when(F.col("in_source") == 0, "extra")
        .when(F.col("in_source") > 1, "repeated")
        .when(F.size("columns") > 0, "differs")
    )
    judged = grouped.withColumn("columns", unlike).withColumn("status", status).where("status IS NOT NULL")
    shown = F.when(F.col("status") == "differs", F.col("columns")).otherwise(F.array().cast("array<string>"))
    return judged.select(*keys, "status", shown.alias("columns"))


RANGE_ROWS, FAN_OUT = 8, 64  # rows of a smallest range, and smallest ranges of a range above it


def unequal_rows(source: DataFrame, graph: DataFrame, keys: Sequence[str], rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides whose key lies in a range of key hashes that has unequal checksums.

    Ranges have a count and a checksum of all values, computed before the shuffle; only
    unequal ones are looked into, and of these only the unequal smaller ones are returned.
    ``rows`` is the size of the tables, about (default: it is counted).  Both sides are read
    once for each of the two levels and again for the result, so they should be stored.
    """
    props = [c for c in graph.columns if c not in keys]
    kinds = {f.name: f.dataType for f in graph.schema.fields}
    source = source.select(*[F.col(quoted(c)).cast(kinds[c]).alias(c) for c in graph.columns])
    smallest = max(1, (graph.count() if rows is None else rows) // (RANGE_ROWS * FAN_OUT)) * FAN_OUT

    def within(df: DataFrame, ranges: int) -> DataFrame:
        return df.withColumn("_range", F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(ranges)))

    # The hash passes nulls over, so where they stand is hashed too.
    nulls = F.concat(F.lit(""), *[F.col(quoted(p)).isNull().cast("string") for p in props])
    value = F.xxhash64(*[quoted(c) for c in [*keys, *props]], nulls)
    sides = source, graph
    for ranges in (smallest // FAN_OUT, smallest):
        sums = [within(df, ranges).select("_range", value.alias("_value"), F.lit(sign).alias("_n")) for df, sign in zip(sides, (1, -1))]
        found = sums[0].unionByName(sums[1]).groupBy("_range").agg(F.bit_xor("_value").alias("x"), F.sum("_n").alias("n")).where("x <> 0 OR n <> 0")
        sides = tuple(within(df, ranges).join(found.select("_range"), "_range", "left_semi").drop("_range") for df in sides)
    return sides


def reconcile_ranges(source: DataFrame, graph: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """``reconcile`` of two tables that hardly differ: whole rows move only from ranges whose checksums do.

    See ``unequal_rows``.  Two ranges are taken for equal if their 64-bit checksums agree.
    """
    if set(source.columns) != set(graph.columns):
        raise ValueError(f"columns differ: {source.columns} and {graph.columns}")
    return reconcile(*unequal_rows(source, graph, keys, rows), keys)
