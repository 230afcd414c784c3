"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``BLOCK`` documents in a pseudo-random order.  With
integer weights w of sum W, block j (from nought) of a source may not be placed before
slot j*W/w and must be placed before slot (j+1)*W/w; the earliest deadline among the
released blocks gets the slot.  At every slot a source's share then differs from its
target by less than one block.  The driver goes over the blocks once (not the documents),
with heaps of the sources, and writes their slots to the shared folder part by part.

Without explicit weights a source weighs the square root of its documents, to 64 binary
places; explicit weights are taken as the decimals they are written as.  Sources that
have no explicit weight above nought weigh one part in ``RESOLUTION`` together.

No document is dropped or repeated.  ``in_mix`` marks the blocks before the first slot at
which some source has none left, where the shares hold; the others follow in the order
of their deadlines.  A null source is a source of its own.  Repeated rows are placed
each; rows without an id are ordered by a hash of the whole row, and so are different rows
with the same id.  Columns of the results' names are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush, heapreplace
from itertools import islice
from math import isqrt, lcm

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from graphtide.llm.common import named, stored
from graphtide.streaming.files import shared_dir

BLOCK = 32
RESOLUTION = 1000
BUCKET = 4_000  # documents of a source that are ranked together, about
PART = 500_000  # blocks that the driver holds at once


def _weights(sources: list[tuple[str, int]], weights: dict[str, float] | None) -> list[int]:
    """Integer weights of the sources, given as (key, documents)."""
    if weights is None:
        return [isqrt(n << 128) for _, n in sources]
    given = {"=" + k: max(Fraction(0), Fraction(str(w))) for k, w in weights.items()}
    own = [given.get(key, Fraction(0)) for key, _ in sources]
    rest = (sum(own) or Fraction(1)) / RESOLUTION / max(1, own.count(0))
    own = [w or rest for w in own]
    scale = lcm(*(w.denominator for w in own))
    return [int(w * scale) for w in own]


def schedule(weights: list[int], blocks: list[int]) -> Iterator[tuple[int, int, bool]]:
    """(source, block, in the mix) of each slot in turn, for ``blocks`` of each source."""
    total = sum(weights)
    due = lambda i, j: -(-(j + 1) * total // weights[i])
    done = [0] * len(weights)
    ready = [(due(i, 0), i) for i in range(len(weights))]  # released, by deadline
    heapify(ready)
    waiting: list[tuple[int, int]] = []  # by release
    slot = 0
    while ready or waiting:
        while waiting and waiting[0][0] <= slot:
            i = heappop(waiting)[1]
            heappush(ready, (due(i, done[i]), i))
        i = ready[0][1]
        if done[i] == blocks[i]:
            break
        heappop(ready)
        yield i, done[i], True
        done[i] += 1
        heappush(waiting, (done[i] * total // weights[i], i))
        slot += 1
    left = [(due(i, j), i) for i, j in enumerate(done) if j < blocks[i]]
    heapify(left)
    while left:
        i = left[0][1]
        yield i, done[i], False
        done[i] += 1
        if done[i] < blocks[i]:
            heapreplace(left, (due(i, done[i]), i))
        else:
            heappop(left)


def _slots(counts: DataFrame, weights: dict[str, float] | None, block: int) -> DataFrame:
    """(␟key, ␟block, ␟slot, in_mix) of every block; ``counts`` has (key, n)."""
    spark = counts.sparkSession
    sources = sorted(((r["key"], r["n"]) for r in counts.toLocalIterator()), key=lambda s: s[0].encode("utf-8", "surrogatepass"))
    placed = enumerate(schedule(_weights(sources, weights), [-(-n // block) for _, n in sources]))
    path = shared_dir(spark, "mixing-slots")
    schema = pa.schema([("␟key", pa.string()), ("␟block", pa.int64()), ("␟slot", pa.int64()), ("in_mix", pa.bool_())])
    form = "`␟key` string, `␟block` bigint, `␟slot` bigint, in_mix boolean"
    first = True
    while (part := list(islice(placed, PART))) or first:
        columns = [[sources[i][0] for _, (i, _, _) in part], [j for _, (_, j, _) in part], [t for t, _ in part], [m for _, (_, _, m) in part]]
        spark.createDataFrame(pa.table(columns, schema=schema), form).write.mode("append").parquet(path)
        first = False
    return spark.read.schema(form).parquet(path)


def mix_sources(
    docs: DataFrame, *, id: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None, seed: int = 0, block: int = BLOCK,
) -> DataFrame:
    """All rows with ``mix_slot`` (of their block), ``mix_block`` (the block's number in its source), ``mix_rank`` (in the source) and ``in_mix``."""
    made = ("mix_slot", "mix_block", "mix_rank", "in_mix")
    kept = [c for c in docs.columns if c.lower() not in made]
    key = F.when(named(source).isNull(), "").otherwise(F.concat(F.lit("="), named(source).cast("string")))
    whole = F.xxhash64(F.to_json(F.struct(*[named(c) for c in docs.columns])))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(named(id).cast("string"), whole.cast("string"))))
    keyed = docs.select(*[named(c) for c in kept], key.alias("␟key"), order.alias("␟order"), whole.alias("␟whole"))
    counts = docs.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    counts = stored(counts, "mixing-sources")
    slots = _slots(counts, weights, block)
    pattern = counts.select(F.col("key").alias("␟key"), F.ceil(F.col("n") / BUCKET).alias("buckets"))

    # A source is ranked in buckets of its order, so that a large one is not one task's.
    bucket = F.shiftright(F.conv(F.substring("␟order", 1, 8), 16, 10).cast("bigint") * F.col("buckets"), 32)
    sizes = keyed.select("␟key", "␟order").join(pattern, "␟key").groupBy("␟key", bucket.alias("␟bucket")).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("␟key").orderBy("␟bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("␟key", "␟bucket", "size", F.coalesce(before, F.lit(0)).alias("␟before"))
    # The slots of a bucket's blocks go to it in a list, so that no document is moved for its slot.
    at = lambda rank: F.floor(rank / block)
    own = offsets.withColumn("␟block", F.explode(F.sequence(at(F.col("␟before")), at(F.col("␟before") + F.col("size") - 1)))).join(slots, ["␟key", "␟block"])
    offsets = own.groupBy("␟key", "␟bucket", "␟before").agg(F.array_sort(F.collect_list(F.struct("␟block", "␟slot", "in_mix"))).alias("␟slots"))

    placed = keyed.join(pattern, "␟key").withColumn("␟bucket", bucket)
    number = F.row_number().over(Window.partitionBy("␟key", "␟bucket").orderBy("␟order", named(id), "␟whole"))
    ranked = placed.withColumn("␟number", number).join(offsets, ["␟key", "␟bucket"])
    rank = F.col("␟before") + F.col("␟number") - 1
    ranked = ranked.withColumn("␟rank", rank).withColumn("␟block", at(F.col("␟rank")))
    place = F.get("␟slots", (F.col("␟block") - at(F.col("␟before"))).cast("int"))
    return ranked.select(
        *[named(c) for c in kept], place["␟slot"].alias("mix_slot"), F.col("␟block").alias("mix_block"), F.col("␟rank").alias("mix_rank"),
        place["in_mix"].alias("in_mix"))
