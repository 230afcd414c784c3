"""Near duplicates by BagMinHash: signatures of weighted sets, bands, exact verification.

A text is the multiset of its five-word shingles (fewer words: one shingle), its weights
are the counts.  Each shingle has independent Poisson processes over (weight, time), one
for each dyadic piece of the weight axis; a point belongs to a text if its discretised
weight is within the shingle's count.  The points fall on the components of the
signature, and the earliest point of a component is its value: two texts agree in a
component with the probability of their weighted Jaccard similarity.  Points are drawn in
order of time and only up to the time by which all components are filled.

Texts with the same words are one node.  Nodes that share a band are candidates; a pair
is a link when the exact weighted similarity is at least ``SIMILARITY``.  Within a band's
bucket nodes are first compared with one node each, then only across components that are
still apart, so a group of thousands of copies needs about one comparison for each of
them, and no pair that could join two components is left out.  In that last step each
node brings a longer signature of one bit a component: a pair whose bits differ more than
``SKETCH_MISSES`` allows (a similarity of 0.8 does so with probability 3e-5), or that would
need more shingles in common than either shares with any other node, is ruled out within
the join, which keeps a family of looser copies from being expanded into pairs.  A crowded bucket is
cut into tiles for it.

With 32 bands of 6 components, a pair at similarity 0.8 is missed with probability 6e-5.

A null text and one without words is alone in its class.  Repeated rows are copies.  Columns
of the results' names are replaced.  Of each class the first row stays (``kept``) and gives ``class_id``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from graphtide.llm.common import RADIX, Words, annotate, mixed, named, stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
COMPONENTS = BANDS * ROWS
STAR_ROUNDS = 2
SKETCH = 2048
# Bits agree with probability (1 + similarity) / 2; four standard deviations below 0.8.
SKETCH_MISSES = int(SKETCH * 0.1 + 4 * (SKETCH * 0.09) ** 0.5)
CELLS = 100_000  # components of the texts that are drawn together; about a dozen points each
# Ids up to which a semi-join may broadcast them (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
# Shingles up to which the multisets of a round are broadcast (8 bytes each, in all the 10 MB up to
# which Spark broadcasts by default); beyond, pairs and multisets are joined by a shuffle.
BROADCAST_SHINGLES = 1_250_000
TILE = 1000  # nodes of a bucket that a task compares with as many others
_ROW = "␟row"
_U = np.uint64


class Bags:
    """Shingles of a batch of texts, with their counts."""

    def __init__(self, texts: pa.Array) -> None:
        doc = Words(texts)
        words = doc.hashes()
        self.texts = len(texts)
        count = doc.count
        shingles = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
        text = np.repeat(np.arange(len(texts)), shingles)
        at = doc.first[:-1][text] + np.arange(shingles.sum()) - np.repeat(np.cumsum(shingles) - shingles, shingles)
        length = np.minimum(count, SHINGLE)[text]
        code = length.astype(_U)
        for j in range(SHINGLE):
            inside = length > j
            code = np.where(inside, code * _U(RADIX) + words[np.where(inside, at + j, 0)] if len(words) else code, code)
        code = mixed(code)
        # Equal shingles of a text side by side.
        key = mixed(code + text.astype(_U) * _U(RADIX))
        order = np.argsort(key)
        key = key[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.count = np.diff(np.append(begin, len(key)))
        self.code, self.text = code[order[begin]], text[order[begin]]
        self.weight = shingles
        self.words, self.first = words, doc.first

    def keys(self) -> np.ndarray:
        """128 bits for the words of each text, as two columns."""
        out, n = [], np.diff(self.first)
        # A running sum with a weight for each place in its text.
        place = np.arange(len(self.words)) - np.repeat(self.first[:-1], n)
        factor = mixed(place.astype(_U) + _U(1)) | _U(1)
        for salt in (_U(0x51ED270B), _U(0xA5B35705)):
            total = np.concatenate([np.zeros(1, _U), np.cumsum(mixed(self.words + salt) * factor, dtype=_U)])
            out.append(mixed(total[self.first[1:]] - total[self.first[:-1]] + n.astype(_U) * salt))
        return np.stack(out, 1)

    def expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """The multisets as sets, the k-th copy of a shingle an element of its own; and their texts."""
        copy = np.arange(self.count.sum()) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        return mixed(np.repeat(self.code, self.count) + copy.astype(_U)), np.repeat(self.text, self.count)


def signatures(bags: Bags, components: int = COMPONENTS) -> np.ndarray:
    """Signature of each text, a row of ``components``; texts without shingles have noughts."""
    out = np.zeros((bags.texts, components), _U)
    order = np.argsort(bags.text, kind="stable")
    code, text, count = bags.code[order], bags.text[order], bags.count[order]
    step = max(1, CELLS // components)
    for a in range(0, bags.texts, step):
        low, high = np.searchsorted(text, [a, a + step])
        _fill(out[a : a + step], code[low:high], text[low:high] - a, count[low:high], bags.weight[a : a + step])
    return out


def _fill(out: np.ndarray, code: np.ndarray, text_of: np.ndarray, count: np.ndarray, weight: np.ndarray) -> None:
    components = out.shape[1]
    levels = np.ceil(np.log2(count)).astype(np.int64) + 1  # pieces (0,1], (1,2], (2,4], ...
    item = np.repeat(np.arange(len(code)), levels)
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    seeds = mixed(code[item] + level.astype(_U) * _U(RADIX))
    lower = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(lower, 1)
    texts, most = text_of[item], count[item]
    todo = weight > 0
    until = np.where(todo, (np.log(components) + 2) / np.maximum(weight, 1), 0)
    while todo.any():
        own = np.flatnonzero(todo[texts])
        seed, text, wide, low, high = seeds[own], texts[own], width[own], lower[own], most[own]
        time, step = np.zeros(len(own)), 0
        earliest = np.full(out.size, np.inf)
        cells, times, values = [], [], []
        while len(seed):
            drawn = mixed(seed + _U(step * 0xD1342543DE82EF95 % (1 << 64)))
            time = time - np.log(((drawn >> _U(11)).astype(np.float64) + 1) * 2.0**-53) / (components * wide)
            live = time <= until[text]
            seed, text, wide, low, high, time, drawn = (x[live] for x in (seed, text, wide, low, high, time, drawn))
            value = mixed(drawn + _U(0x2545F4914F6CDD1D))
            cell = text * components + ((value >> _U(33)) * _U(components) >> _U(31)).astype(np.int64)
            within = low + ((value & _U(0xFFFFFFFF)) * wide.astype(_U) >> _U(32)).astype(np.int64) < high
            cells.append(cell[within])
            times.append(time[within])
            values.append(value[within])
            step += 1
        cell, when, value = np.concatenate(cells), np.concatenate(times), np.concatenate(values)
        np.minimum.at(earliest, cell, when)
        first = when == earliest[cell]
        flat = out.ravel()
        flat[cell[first]] = value[first]
        todo = todo & np.isinf(earliest.reshape(out.shape)).any(1)
        until = np.where(todo, until * 2, until)


SIGNED = [StructField("␟key", BinaryType()), StructField("␟weight", LongType()), StructField("␟bands", ArrayType(LongType(), False))]


def _sign() -> Callable[[pa.Array], list]:
    def columns(texts: pa.Array) -> list[pa.Array]:
        bags = Bags(texts)
        signed = signatures(bags)
        bands = np.zeros((bags.texts, BANDS), _U) + np.arange(BANDS, dtype=_U)
        for k in range(ROWS):
            bands = mixed(bands * _U(RADIX) + signed[:, k::ROWS])
        wordless = bags.weight == 0
        keys = np.ascontiguousarray(bags.keys()).tobytes()
        lists = np.repeat(~wordless, BANDS)
        return [
            pa.array([None if none else keys[16 * i : 16 * i + 16] for i, none in enumerate(wordless)], pa.binary()),
            pa.array(bags.weight, pa.int64()),
            pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.where(wordless, 0, BANDS))]).astype(np.int32), pa.array(bands.view(np.int64).ravel()[lists])),
        ]

    return columns


BAG = [StructField("bag", ArrayType(LongType(), False))]
SKETCHED = [*BAG, StructField("sketch", ArrayType(LongType(), False))]


def _shingles(sketched: bool) -> Callable[[pa.Array], list]:
    def columns(texts: pa.Array) -> list[pa.Array]:
        bags = Bags(texts)
        codes, text = bags.expanded()
        order = np.argsort(text, kind="stable")
        size = np.bincount(text, minlength=len(texts))
        made = [pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), pa.array(codes[order].view(np.int64)))]
        if sketched:
            bits = np.packbits((signatures(bags, SKETCH) & _U(1)).astype(np.uint8), axis=1).view(np.int64)
            made.append(pa.ListArray.from_arrays(np.arange(0, bits.size + 1, SKETCH // 64, dtype=np.int32), pa.array(bits.ravel())))
        return made

    return columns


def _bags(signed: DataFrame, nodes: DataFrame, purpose: str, sketched: bool = False) -> DataFrame:
    """The multisets of the nodes (a column of rows), as sets; with their bands and sketches if wanted."""
    ids = stored(nodes.distinct(), f"near-dup-nodes-{purpose}")
    small = ids.count() <= BROADCAST_IDS
    texts = signed.select(_ROW, "␟bands", "␟body").join(F.broadcast(ids) if small else ids, _ROW, "left_semi")
    keep = [_ROW, "␟bands"] if sketched else [_ROW]
    return stored(annotate(texts, "␟body", SKETCHED if sketched else BAG, partial(_shingles, sketched), keep), f"near-dup-bags-{purpose}")


def _verified(bags: DataFrame, pairs: DataFrame, purpose: str) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""
    size = bags.agg(F.sum(F.size("bag").cast("bigint"))).head()[0] or 0
    side = (lambda df: F.broadcast(df)) if size <= BROADCAST_SHINGLES else (lambda df: df)
    both = (
        pairs.join(side(bags.select(F.col(_ROW).alias("b"), F.col("bag").alias("bag_b"))), "b")
        .join(side(bags.select(F.col(_ROW).alias("a"), F.col("bag").alias("bag_a"))), "a")
    )
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    return stored(both.where(common >= SIMILARITY * (F.size("bag_a") + F.size("bag_b") - common)).select("a", "b"), f"near-dup-links-{purpose}")


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) of all nodes with an edge (a, b); a component is named by its least node.

    Each round gives every label the least label beside it, follows that twice, and
    keeps the edges between labels that still differ, so the labels at least halve.
    """
    current, labels, number = edges.where("a <> b"), None, 0
    while True:
        both = current.select("a", "b").union(current.select("b", "a"))
        parent = stored(both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("x"), F.least("a", "p").alias("p")), f"{purpose}-parent-{number}")
        follow = parent.select(F.col("x").alias("p"), F.col("p").alias("q"))
        step = parent.join(follow, "p").select("x", F.col("q").alias("p")).join(follow, "p").select("x", F.col("q").alias("root"))
        step = stored(step, f"{purpose}-step-{number}")
        if labels is None:
            labels = step.select(F.col("x").alias("node"), F.col("root").alias("component"))
        else:
            renamed = step.select(F.col("x").alias("component"), "root")
            labels = stored(labels.join(renamed, "component", "left").select("node", F.coalesce("root", "component").alias("component")), f"{purpose}-labels-{number}")
        current = (
            current.join(step.select(F.col("x").alias("a"), F.col("root").alias("ra")), "a").join(step.select(F.col("x").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
        current = stored(current, f"{purpose}-edges-{number}")
        number += 1
        if current.isEmpty():
            return labels


def _similar_size(a: str, b: str):
    """Whether the sizes of two multisets leave room for the similarity."""
    return (F.col(a) >= SIMILARITY * F.col(b)) & (F.col(b) >= SIMILARITY * F.col(a))


def find_near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``class_id`` (the id of the first row of the class) and ``kept`` (whether it is that row)."""
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("class_id", "kept")]
    source = docs.select(*[named(c) for c in dict.fromkeys([*kept, id])], F.monotonically_increasing_id().alias(_ROW), named(text).cast("string").alias("␟body"))
    signed = stored(annotate(source, "␟body", SIGNED, _sign), "near-dup-signed")

    # Only keys that occur again are joined, to a written table: a hot key's rows can then be split over tasks.
    worded, wordless = signed.where("`␟key` is not null").select(_ROW, "␟key"), signed.where("`␟key` is null").select(_ROW, F.col(_ROW).alias("node"))
    copies = worded.groupBy("␟key").agg(F.min(_ROW).alias("node"), F.count("*").alias("n")).where("n > 1").select("␟key", "node")
    members = worded.join(stored(copies, "near-dup-copies"), "␟key", "left").select(_ROW, F.coalesce("node", _ROW).alias("node"))
    members = stored(members.unionByName(wordless), "near-dup-members")

    nodes = signed.join(members.where(F.col(_ROW) == F.col("node")).select(_ROW), _ROW, "left_semi").select(F.col(_ROW).alias("node"), F.col("␟weight").alias("weight"), "␟bands")
    buckets = stored(nodes.select("node", "weight", F.explode("␟bands").alias("bucket")), "near-dup-buckets")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    crowded = stored(buckets.join(shared, "bucket"), "near-dup-crowded").select("bucket", "node", "weight", "n")
    # How many others a node meets, over its buckets: most for the one that a family's copies were made from.
    meets = stored(crowded.groupBy("node").agg(F.sum("n").alias("meets")), "near-dup-meets")

    # Each node with the most met node of one of its buckets; then again with other nodes, across components.
    links, labels = None, None
    for number in range(STAR_ROUNDS):
        apart = crowded.withColumn("component", F.col("node")) if labels is None else _apart(crowded, labels)
        # The star's centre differs from round to round.
        apart, rank = (apart.join(meets, "node"), -F.col("meets")) if number == 0 else (apart, F.xxhash64("node", F.lit(number)))
        centre = apart.groupBy("bucket").agg(F.min(F.struct(rank.alias("rank"), "node", "weight", "component")).alias("c"))
        pairs = (
            apart.join(centre, "bucket").where((F.col("component") != F.col("c.component")) & _similar_size("weight", "c.weight"))
            .groupBy("node").agg(F.min("c.node").alias("other"))
        )
        pairs = stored(_ordered(pairs), f"near-dup-pairs-{number}")
        ends = pairs.select(F.col("a").alias(_ROW)).union(pairs.select("b"))
        found = _verified(_bags(signed, ends, str(number)), pairs, str(number))
        links = found if links is None else links.unionByName(found)
        if not links.isEmpty():
            labels = components(links, f"near-dup-{number}")

    # What is still apart is compared in full, each pair in the first bucket that both are in.
    apart = crowded.withColumn("component", F.col("node")) if labels is None else _apart(crowded, labels)
    bags = _bags(signed, apart.select(F.col("node").alias(_ROW)), "rest", sketched=True)
    single = bags.select(_ROW, F.explode("bag").alias("shingle"))
    common = single.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    room = single.join(common, "shingle").groupBy(_ROW).agg(F.count("*").alias("room"))
    room = stored(room.where(F.col("room") > 0), "near-dup-room").select(F.col(_ROW).alias("node"), "room")
    near = stored(apart.join(room, "node").where(F.col("room") >= SIMILARITY * F.col("weight")), "near-dup-near")
    # A crowded bucket is compared tile by tile: each pair of nodes meets in one of its pairs of tiles.
    crowds = near.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > TILE).select("bucket", F.ceil(F.col("n") / TILE).alias("tiles"))
    near = near.join(stored(crowds, "near-dup-tiles"), "bucket", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1).cast("bigint")))
    near = near.withColumn("own", F.pmod(F.xxhash64("node"), "tiles"))
    near = near.join(bags.select(F.col(_ROW).alias("node"), F.col("␟bands").alias("bands"), "sketch"), "node")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    other = near.withColumn("left", every).select("bucket", "left", F.col("own").alias("right"), *[F.col(c).alias(f"other_{c}") for c in ("node", "weight", "component", "room", "bands", "sketch")])
    overlap = F.least("room", "other_room")
    fits = overlap >= SIMILARITY * (F.col("weight") + F.col("other_weight") - overlap)
    misses = F.aggregate(F.zip_with("sketch", "other_sketch", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, x: a + x)
    across = (F.col("component") < F.col("other_component")) & _similar_size("weight", "other_weight") & fits & (misses <= SKETCH_MISSES)
    near = near.withColumn("right", every).withColumn("left", F.col("own"))
    pairs = near.join(other, ["bucket", "left", "right"]).where(across & (F.array_min(F.array_intersect("bands", "other_bands")) == F.col("bucket")))
    pairs = stored(_ordered(pairs.select("node", F.col("other_node").alias("other"))), "near-dup-pairs-rest")
    if not pairs.isEmpty():
        found = _verified(bags, pairs, "rest")
        links = links.unionByName(found)
        if not found.isEmpty():
            labels = components(links, "near-dup-rest")

    whole = members
    if labels is not None:
        whole = members.join(labels, "node", "left").select(_ROW, F.coalesce("component", "node").alias("node"))
    first = signed.select(F.col(_ROW).alias("node"), named(id).alias("class_id"))
    classes = whole.join(first, "node").select(_ROW, "class_id", (F.col("node") == F.col(_ROW)).alias("kept"))
    return signed.select(*kept, _ROW).join(classes, _ROW).drop(_ROW)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _apart(crowded: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets that hold more than one component."""
    known = crowded.join(labels, "node", "left").select("bucket", "node", "weight", F.coalesce("component", "node").alias("component"))
    mixed_buckets = known.groupBy("bucket").agg(F.min("component").alias("l"), F.max("component").alias("h")).where("l < h").select("bucket")
    return stored(known.join(mixed_buckets, "bucket"), "near-dup-apart").select("bucket", "node", "weight", "component")
