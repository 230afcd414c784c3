from collections import Counter

import duckdb
from pyspark.sql import functions as F

from graphtide.llm import sql
from graphtide.llm.mixing import RESOLUTION, mix_sources, schedule
from tests.compare import compare


def deviations(rows, weights):
    """Largest distance of a source's blocks from its target at any slot of the mix."""
    slots = sorted({(r.mix_slot, r.source) for r in rows if r.in_mix})
    assert [s for s, _ in slots] == list(range(len(slots)))
    total, seen, worst = sum(weights.values()), Counter(), 0.0
    for t, (_, source) in enumerate(slots):
        seen[source] += 1
        worst = max(worst, *(abs(seen[s] - (t + 1) * w / total) for s, w in weights.items()))
    return worst


def test_less_than_one_block_from_target(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.pmod("id", F.lit(7)).cast("string")).alias("source"), F.lit("x").alias("mix_slot"))
    weights = {"s0": 0.31, "s1": 0.2, "s2": 0.17, "s3": 0.15, "s4": 0.1, "s5": 0.05, "s6": 0.02}
    rows = mix_sources(docs, weights=weights, block=2).collect()
    assert len(rows) == 3000 and sorted(r.doc_id for r in rows) == list(range(3000))
    assert deviations(rows, {s: round(RESOLUTION * w) for s, w in weights.items()}) < 1
    for source in weights:
        own = sorted((r.mix_rank, r.mix_block, r.mix_slot) for r in rows if r.source == source)
        assert [r[0] for r in own] == list(range(len(own))) and all(b == k // 2 for k, b, _ in own)
        assert [r[2] for r in own] == sorted(r[2] for r in own)
    per_slot = Counter(r.mix_slot for r in rows)
    assert max(per_slot.values()) <= 2


def test_unrounded_targets(spark):
    third = F.when(F.pmod("id", F.lit(3)) == 0, "hot").otherwise(F.concat(F.lit("s"), F.pmod(F.floor(F.col("id") / 3), F.lit(19)).cast("string")))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), third.alias("source"))
    rows = mix_sources(docs, block=1).collect()
    sizes = Counter(r.source for r in rows)
    assert sum(r.in_mix for r in rows) > 4000 and deviations(rows, {s: n**0.5 for s, n in sizes.items()}) < 1
    assert sorted(r.mix_slot for r in rows) == list(range(6000))

    docs = spark.range(5010).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 10, "rare").otherwise("often").alias("source"))
    weights = {"rare": 0.0004, "often": 0.9996}
    assert deviations(mix_sources(docs, weights=weights, block=1).collect(), weights) < 1


def test_many_sources():
    weights = [1000, *[1] * 50_000]
    placed = list(schedule(weights, [2000, *[2] * 50_000]))
    assert len(set(placed)) == len(placed) == 102_000 and all(m for _, _, m in placed)
    assert abs(sum(i == 0 for i, _, _ in placed[:25_500]) - 500) < 1


def test_rows(spark, documents):
    docs = documents([(1, "a", "en", None), (1, "a", "en", None), (2, None, "en", ""), (3, "b", "en", "s"), (None, "c", "en", "s")])
    rows = mix_sources(docs, block=1).collect()
    assert len(rows) == 5 and {"gram", "rule"} <= set(rows[0].asDict())
    assert sorted(r.mix_rank for r in rows if r.source is None) == [0, 1] and sum(r.in_mix for r in rows) > 0
    assert mix_sources(docs.where("false")).count() == 0
    assert mix_sources(docs, weights={"other": 1.0}).count() == 5


def test_sql_of_unequal_sources(spark, tmp_path):
    n = F.col("id")
    third = F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).when(n % 50 == 2, "").otherwise(F.concat(F.lit("s"), F.floor(F.sqrt(n % 400)).cast("string")))
    spark.range(6000).select(n.alias("doc_id"), third.alias("source")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert compare(mix_sources(docs), con, sql.MIXING) is None
    assert mix_sources(docs).where("not in_mix").count() > 1000


def test_rows_without_ids_and_clashing_columns(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.col("id").alias("own"), F.lit(1).alias("MIX_SLOT"), F.lit(2).alias("In_Mix"))
    first, again = (sorted((r.mix_rank, r.own) for r in mix_sources(d).collect()) for d in (docs, docs.repartition(7, "own")))
    assert first == again and [r for r, _ in first] == list(range(4000)) and [o for _, o in first] != list(range(4000))
    assert mix_sources(docs).columns == ["doc_id", "source", "own", "mix_slot", "mix_block", "mix_rank", "in_mix"]
    twins = docs.withColumn("doc_id", F.lit(5).cast("long"))
    first, again = (sorted((r.mix_rank, r.own) for r in mix_sources(d).collect()) for d in (twins, twins.repartition(7, "own")))
    assert first == again
