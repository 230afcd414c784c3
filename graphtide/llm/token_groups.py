"""Exact Jaccard join of documents on word shingles, by a token-group matrix.

A document is the set of its five-word shingles (fewer words: the whole sequence is one).
Two link if 100 times the common shingles are at least ``PERCENT`` times the united ones;
a component is what links reach.

Equal sets are one node.  Similar nodes are partitioned into groups: nodes that agree in two
minimum hashes (a lot; each node is in ``LOTS`` of them) are compared within bounded blocks
(a large lot is split, its leader is in every block).  The groups are parts, of
about ``GROUP_NODES`` or ``GROUP_SHINGLES``, of the components that this yields, and of the unlinked nodes of a lot;
a node without a lot is a group of its own.

The matrix has a row for each shingle and group: the group's token union.  A query node can
only link into a group of another component that holds enough of its shingles, so it
looks up its rarest ones: among a node's first n - ceil(0.8 n) + k shingles, in any fixed
order, k are among the first m - ceil(8/9 m) + k of any smaller node of size m that it links
to (``AGREE``; fewer where a node is smaller).  Only these have entries in the matrix.  The order puts frequent shingles last, so a
passage that many documents share is hardly ever looked up; and what comes before a common
shingle on either side is lost to the overlap, which rules most groups out at once.  For each group found, the
query's overlap with the whole token union bounds its overlap with each member; only a
group that the bound lets through is opened, and its members are compared.

Nothing is approximate but the hashes (64 bits a shingle, 128 a set).  The result does not
depend on groups, blocks or order, which only save work.

A null text and one without words have no shingles and are alone; repeated rows are equal
sets; null ids are passed over when a component's least id is taken (null if it has no
other).  Columns of the results' names are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from graphtide.llm.common import LOWER, NOT_BLANK, RADIX, Words, annotate, mixed, named, pieces, stored
from graphtide.llm.near_dup import components

SHINGLE = 5
PERCENT = 80
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 18  # of nodes that are compared with each other at once
GROUP_NODES, GROUP_SHINGLES = 256, 1 << 20
QUERIES, QUERY_SHINGLES = 512, 1 << 20  # that look into one group in a task
FREQUENT = 8  # documents that make a shingle a frequent one
MOST_FREQUENT = 1_000_000  # frequent shingles that the order tells apart; a broadcast of 5 MB
# Shingles are counted if their hash is in the lower 5/16: rare ones are looked up from the least hash on,
# a fifth of a document, and this leaves room for a third of frequent ones.
COUNTED = np.uint64(5 << 60)
BROADCAST_ROWS = 1_000_000  # keys up to which a join may broadcast them; more are joined by a shuffle
LOTS = 4
AGREE = 4  # looked-up shingles that a group must hold
TOGETHER, ENTRIES = 8, 1 << 15  # nodes of a group that ask as one; shingles met by one group's nodes in a task
WHOLE, SPARE = 100 + PERCENT, (100 + PERCENT) * (AGREE - 1)
FOUND = ["node", "n", "component", "into", "part"]
CHUNK = 4096
_ROW = "␟row"
_U = np.uint64


class Sets:
    """Shingle sets of a batch of texts; ``code`` has them text by text, in the order of their hashes."""

    def __init__(self, texts: pa.Array) -> None:
        doc = Words(texts, NOT_BLANK, LOWER)
        words, count = doc.hashes(), doc.count
        shingles = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
        text = np.repeat(np.arange(len(texts)), shingles)
        at = doc.first[:-1][text] + np.arange(shingles.sum()) - np.repeat(np.cumsum(shingles) - shingles, shingles)
        length = np.minimum(count, SHINGLE)[text]
        code = length.astype(_U)
        for j in range(SHINGLE):
            inside = length > j
            code = np.where(inside, code * _U(RADIX) + words[np.where(inside, at + j, 0)], code)
        code = mixed(code)
        order = np.argsort(code)
        order = order[np.argsort(text[order], kind="stable")]
        code, text = code[order], text[order]
        fresh = np.ones(len(code), bool)
        fresh[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
        self.code, self.text = code[fresh], text[fresh]
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def _sums(self, salt: int) -> np.ndarray:
        total = np.concatenate([np.zeros(1, _U), np.cumsum(mixed(self.code + _U(salt)), dtype=_U)])
        return mixed(total[self.first[1:]] - total[self.first[:-1]] + self.count.astype(_U))

    def keys(self) -> pa.Array:
        """128 bits for each set, null for an empty one."""
        data = np.stack([self._sums(0x51ED270B), self._sums(0xA5B35705)], 1).tobytes()
        return pa.array([data[16 * i : 16 * i + 16] if n else None for i, n in enumerate(self.count.tolist())], pa.binary())

    def lots(self) -> pa.Array:
        """Pairs of minimum hashes of each set, a number for each pair; similar sets often agree in one."""
        filled = self.count > 0
        out = np.zeros((filled.sum(), LOTS), _U)
        for i in range(2 * LOTS if len(out) else 0):
            least = np.minimum.reduceat(mixed(self.code + _U(0x2545F4914F6CDD1D * (i + 1) % (1 << 64))), self.first[:-1][filled])
            out[:, i // 2] = mixed(out[:, i // 2] * _U(RADIX) + least + _U(i))
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(filled * LOTS)]).astype(np.int32), pa.array(out.ravel().view(np.int64)))

    def lists(self) -> pa.Array:
        return pa.ListArray.from_arrays(self.first.astype(np.int32), pa.array(self.code.view(np.int64)))


def _lookups(n: np.ndarray) -> np.ndarray:
    """How many of its first shingles a query looks up."""
    common = -(-PERCENT * n // 100)
    return n - common + np.minimum(AGREE, common)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, 0):
        code = Sets(piece.column(0)).code
        shingle, n = np.unique((code[code < COUNTED] >> _U(32)).astype(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(shingle.astype(np.int32)), pa.array(n, pa.int32())], names=["shingle", "n"])


def frequent_shingles(docs: DataFrame, *, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The upper 32 bits of frequent shingles, sorted, and the binary logarithms of their documents.

    All documents are counted.  If there are more than ``MOST_FREQUENT``, the least
    frequent ones are left out until the rest fits.
    """
    counted = docs.select(named(text).cast("string")).mapInArrow(_counted, "shingle int, n int").groupBy("shingle").agg(F.sum("n").alias("n"))
    counted = stored(counted.where(F.col("n") >= FREQUENT).select("shingle", F.floor(F.log2("n")).cast("int").alias("level")), "shingle-counts")
    least, total = 99, 0
    for row in sorted(counted.groupBy("level").count().collect(), reverse=True):
        total += row["count"]
        if total > MOST_FREQUENT:
            break
        least = row["level"]
    found = counted.where(F.col("level") >= least).orderBy("shingle").toArrow()
    return found.column("shingle").to_numpy().astype(np.uint32), found.column("level").to_numpy().astype(np.uint8)


FIELDS = [
    StructField("␟key", BinaryType()), StructField("␟lots", ArrayType(LongType(), False)), StructField("n_shingles", LongType()),
    StructField("␟lookups", ArrayType(LongType(), False)),
]


def _signed(frequent) -> Callable[[], Callable[[pa.Array], list]]:
    def work() -> Callable[[pa.Array], list]:
        shingles, levels = frequent.value

        def columns(texts: pa.Array) -> list:
            sets = Sets(texts)
            level = np.zeros(len(sets.code), np.int64)
            if len(shingles):
                upper = (sets.code >> _U(32)).astype(np.uint32)
                at = np.minimum(np.searchsorted(shingles, upper), len(shingles) - 1)
                level = np.where(shingles[at] == upper, levels[at], 0).astype(np.int64)
            order = np.argsort(sets.text * 64 + level, kind="stable")
            many = _lookups(sets.count)
            chosen = order[np.arange(len(order)) - sets.first[:-1][sets.text] < many[sets.text]]
            offsets = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
            return [
                sets.keys(), sets.lots(), pa.array(sets.count, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(sets.code[chosen].view(np.int64)))]

        return columns

    return work


def _keyed() -> Callable[[pa.Array], list]:
    def columns(texts: pa.Array) -> list:
        sets = Sets(texts)
        return [sets.keys(), sets.lists()]

    return columns


def _bounded(df: DataFrame) -> DataFrame:
    """A stored table, to be broadcast where it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _sets(docs: DataFrame, text: str, nodes: DataFrame, wanted: DataFrame, purpose: str) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted``."""
    keys = stored(wanted.select("node").distinct().join(nodes.select("␟key", "node"), "node"), f"{purpose}-keys")
    bodies = docs.select(named(text).cast("string").alias("␟body"))
    made = annotate(bodies, "␟body", [FIELDS[0], StructField("shingles", ArrayType(LongType(), False))], _keyed, [])
    found = made.where("`␟key` is not null").join(_bounded(keys), "␟key")
    return stored(found.groupBy("node").agg(F.first("shingles").alias("shingles")), purpose)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block (first column) of sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for a, b in zip(cuts, cuts[1:]):
            if b == a:
                continue
            if held and held[-1].column(0)[0].as_py() != block[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _incidence(lists: list[np.ndarray], vocabulary: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of a 0/1 matrix over the vocabulary, a number of columns at a time."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    code = np.concatenate(lists)
    column = np.searchsorted(vocabulary, code)
    held = vocabulary[np.minimum(column, len(vocabulary) - 1)] == code
    row, column = row[held], column[held]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, len(vocabulary), CHUNK):
        low, high = np.searchsorted(column, [a, a + CHUNK])
        part = np.zeros((len(lists), min(CHUNK, len(vocabulary) - a)), np.float32)
        part[row[low:high], column[low:high] - a] = 1
        yield part


def _linked(common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return 100 * common >= PERCENT * (left + right - common)


def _lists(table: pa.Table, name: str = "shingles") -> list[np.ndarray]:
    column = table.column(name).combine_chunks()
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that connect what is connected within a block."""
    for table in _groups(batches):
        names, own = np.unique(table.column("node").to_numpy(), return_index=True)  # the leader may come twice
        if len(own) < 2:
            continue
        lists = _lists(table)
        lists = [lists[i] for i in own]
        codes, seen = np.unique(np.concatenate(lists), return_counts=True)
        codes = codes[seen > 1]
        if not len(codes):
            continue
        common = np.zeros((len(lists), len(lists)), np.float64)
        for part in _incidence(lists, codes):
            common += part @ part.T
        n = np.array([len(x) for x in lists])
        near = _linked(common, n[:, None], n[None, :])
        a, b, left = [], [], np.ones(len(n), bool)
        while left.any():
            wave = np.array([left.argmax()])
            left[wave] = False
            while len(wave):
                reached = near[wave] & left
                new = np.flatnonzero(reached.any(0))
                a += names[wave[reached[:, new].argmax(0)]].tolist()
                b += names[new].tolist()
                left[new] = False
                wave = new
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _qualified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, node) of the queries whose overlap with the token union of the block's group allows a link.

    Halves of the hashes do: where they collide, the bound is looser.
    """
    for table in _groups(batches):
        asks, halves = table.column("asks").to_numpy(), _lists(table, "halves")
        union = np.unique(np.concatenate([halves[i] for i in np.flatnonzero(~asks)]))
        queries = np.flatnonzero(asks)
        inside = np.array([np.isin(halves[i], union).sum() for i in queries])
        chosen = table.take(queries[100 * inside >= PERCENT * np.array([len(halves[i]) for i in queries])]).select(["block", "node"])
        yield from chosen.to_batches()


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of queries with members of the block's group, as components (a, b)."""
    for table in _groups(batches):
        asks, component, lists = table.column("asks").to_numpy(), table.column("component").to_numpy(), _lists(table)
        members, asked = ([lists[i] for i in np.flatnonzero(x)] for x in (~asks, asks))
        union = np.unique(np.concatenate(members))
        common = sum(q.astype(np.float64) @ m.T for q, m in zip(_incidence(asked, union), _incidence(members, union)))
        near = _linked(common, np.array([len(x) for x in asked])[:, None], np.array([len(x) for x in members])[None, :])
        links = np.stack([x[i] for x, i in zip((component[asks], component[~asks]), np.nonzero(near))], 1)
        links = np.unique(links[links[:, 0] != links[:, 1]], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0], pa.int64()), pa.array(links[:, 1], pa.int64())], names=["a", "b"])


def _lots(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lots of several nodes (lot, n, leader, parts), and their members (lot, node, n, parts)."""
    member = nodes.select("node", "n_shingles", F.explode("␟lots").alias("lot"))
    lots = member.groupBy("lot").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"), F.min("node").alias("leader")).where("n > 1")
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_NODES, F.col("size") / BLOCK_SHINGLES))
    lots = stored(lots.select("lot", "n", "leader", parts.alias("parts")), "shingle-lots")
    return lots, stored(member.join(lots, "lot").select("lot", "node", "n", "parts"), "shingle-members")


def _within_lots(docs: DataFrame, text: str, nodes: DataFrame, lots: DataFrame, member: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of the same lot."""
    block = F.xxhash64("lot", "part").alias("block")
    roles = member.withColumn("part", F.pmod(F.xxhash64("node", "lot"), "parts")).select(block, "node")
    leaders = lots.where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).select(block, F.col("leader").alias("node"))
    roles = stored(roles.unionByName(leaders), "shingle-blocks")
    blocks = roles.join(_sets(docs, text, nodes, roles, "shingle-lot-sets"), "node").select("block", "node", "shingles")
    return stored(blocks.repartition("block").sortWithinPartitions("block").mapInArrow(_inner, "a bigint, b bigint"), "shingle-inner-links")


def _grouped(nodes: DataFrame, member: DataFrame, labels: DataFrame) -> DataFrame:
    """(␟key, node, component, into, part, size) of all nodes with copies, or with others in their group.

    The parts of components count up from nought, those of lots down from -1.
    """
    fullest = member.join(labels, "node", "left_anti").groupBy("node").agg(F.max(F.struct("n", "lot"))["lot"].alias("into"))
    linked = labels.select("node", "component", F.col("component").alias("into"), F.lit(False).alias("loose"))
    groups = linked.unionByName(fullest.select("node", F.col("node").alias("component"), "into", F.lit(True).alias("loose")))
    groups = stored(groups.join(nodes.select("node", "n_shingles"), "node"), "shingle-grouped")
    sizes = groups.groupBy("into", "loose").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("n")).where("size > 1")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.greatest(F.col("size") / GROUP_NODES, F.col("n") / GROUP_SHINGLES)))
    found = groups.join(sizes, ["into", "loose"]).select("node", "component", "into", F.when(F.col("loose"), -1 - part).otherwise(part).alias("part"), "size")
    found = nodes.select("␟key", "node", "copies").join(found, "node", "left").where("copies > 1 or into is not null")
    own = F.col("node")
    return stored(found.select(
        "␟key", "node", F.coalesce("component", own).alias("component"), F.coalesce("into", own).alias("into"),
        F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("size", F.lit(1)).alias("size")), "shingle-known")


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the block's group that share enough looked-up shingles with a group it met: (node, n, component, into, part)."""
    for table in _groups(batches):
        asks = table.column("asks").to_numpy()
        members, groups = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        node, n, component = (members.column(c).to_numpy() for c in ("node", "n", "component"))
        lookups, met = _lists(members, "lookups"), _lists(groups, "met")
        into, part = groups.column("into").to_numpy(), groups.column("part").to_numpy()
        low, high, room = (np.concatenate(_lists(groups, c)) for c in ("low", "high", "room"))
        asker, code = np.repeat(np.arange(len(node)), [len(x) for x in lookups]), np.concatenate(lookups)
        rest = 100 * n[asker] - WHOLE * np.concatenate([np.arange(len(x)) for x in lookups])
        order = np.argsort(code)
        asker, code, rest = asker[order], code[order], rest[order]
        group, shingle = np.repeat(np.arange(len(into)), [len(x) for x in met]), np.concatenate(met)
        first, last = np.searchsorted(code, shingle), np.searchsorted(code, shingle, "right")
        agree = np.zeros((len(node), len(into)), np.int32)
        for a in range(0, len(shingle), CHUNK):
            many = (last - first)[a : a + CHUNK]
            entry = np.repeat(np.arange(a, a + len(many)), many)
            which = np.repeat(first[a : a + CHUNK] - np.cumsum(many) + many, many) + np.arange(many.sum())
            q, g = asker[which], group[entry]
            fits = (
                ((part[g] < 0) | (component[q] != into[g])) & (low[entry] <= n[q]) & (100 * high[entry] >= PERCENT * n[q])
                & (rest[which] + SPARE >= PERCENT * low[entry]) & (room[entry] + SPARE >= PERCENT * n[q]))
            np.add.at(agree, (q[fits], g[fits]), 1)
        q, g = np.nonzero(agree >= np.minimum(AGREE, -(-PERCENT * n // 100))[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node[q], n[q], component[q], into[g], part[g])], names=FOUND)


def _owned(base: DataFrame, known: DataFrame) -> DataFrame:
    """The nodes with their groups and looked-up shingles."""
    own = base.where("`␟key` is not null").select(_ROW, "␟key", "n_shingles", "␟lookups").join(_bounded(known), "␟key", "left")
    return own.where(F.col("node").isNull() | (F.col("node") == F.col(_ROW))).select(
        F.col(_ROW).alias("node"), F.coalesce("component", _ROW).alias("component"), F.coalesce("into", _ROW).alias("into"), F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("size", F.lit(1)).alias("size"), F.col("n_shingles").alias("n"), "␟lookups")


def _meetings(own: DataFrame) -> DataFrame:
    """Looked-up shingles that askers and groups share, with what would be their bounds.

    A node asks for itself, but the nodes of a group of ``TOGETHER`` ask as one (no ``node``), in
    the widest bounds of those that have the shingle: what many of them share meets a group once.
    """
    n = F.col("n")
    # A link needs (100 + P) * common >= P * (both sizes), and of the common shingles all but AGREE - 1 at
    # most are from this one on: ``rest`` is what a side can have from here on, less its own need.
    rest = 100 * n - WHOLE * F.col("at")
    queries = own.select(F.posexplode("␟lookups").alias("at", "shingle"), "node", "component", "into", "part", "size", "n")
    queries = queries.select(
        "shingle", "node", "component", F.col("into").alias("home"), F.col("part").alias("home_part"), "size", n.alias("least"), n.alias("most"), rest.alias("rest"),
        F.lit(False).alias("mixed"))
    itself = queries.where(F.col("size") < TOGETHER).drop("size")
    as_one = queries.where(F.col("size") >= TOGETHER).groupBy("shingle", "home", "home_part").agg(
        F.lit(None).cast("bigint").alias("node"), F.min("component").alias("component"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.max("rest").alias("rest"), (F.min("component") < F.max("component")).alias("mixed"))
    # A member meets only queries that are no smaller, so fewer of its shingles do.
    common = F.ceil(2 * PERCENT * n / WHOLE)
    first = F.slice("␟lookups", 1, (n - common + F.least(F.lit(AGREE), common)).cast("int"))
    entries = own.select(F.posexplode(first).alias("at", "shingle"), "into", "part", "size", "n")
    entries = entries.select("shingle", "into", "part", "size", n.alias("low"), n.alias("high"), rest.alias("room"))
    alone = entries.where("size = 1").drop("size")
    grouped = entries.where("size > 1").groupBy("shingle", "into", "part").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("room").alias("room"))
    fits = (
        ((F.col("part") < 0) | F.col("mixed") | (F.col("component") != F.col("into"))) & (F.col("low") <= F.col("most")) & (100 * F.col("high") >= PERCENT * F.col("least"))
        & (F.col("rest") + SPARE >= PERCENT * F.col("low")) & (F.col("room") + SPARE >= PERCENT * F.col("least")))
    return itself.unionByName(as_one).join(alone.unionByName(grouped), "shingle").where(fits)


def _lookup(base: DataFrame, known: DataFrame) -> DataFrame:
    """Queries and groups that share enough looked-up shingles: (node, n, component, into, part)."""
    own, home = _owned(base, known), ["home", "home_part"]
    entry = F.when(F.col("node").isNull(), F.struct("shingle", "low", "high", "room"))
    met = _meetings(own).withColumn("component", F.when(F.col("node").isNotNull(), F.col("component"))).groupBy("node", "component", *home, "into", "part").agg(
        F.min("least").alias("n"), F.count("*").alias("agree"), F.collect_list(entry).alias("entries"))
    met = stored(met.where(F.col("agree") >= F.least(F.lit(AGREE), F.ceil(PERCENT * F.col("n") / 100))), "shingle-met")
    by_itself, as_one = met.where("node is not null").select(*FOUND), met.where("node is null")
    asked = stored(as_one.groupBy(*home).agg(F.ceil(F.sum("agree") / ENTRIES).alias("turns")), "shingle-asking")
    if asked.isEmpty():
        return stored(by_itself, "shingle-lookups")

    block = F.xxhash64(*home, "turn").alias("block")
    none = lambda x, kind="bigint": F.lit(None).cast(kind).alias(x)
    members = own.where(F.col("size") >= TOGETHER).withColumnsRenamed({"into": "home", "part": "home_part"}).join(asked, home)
    members = members.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns") - 1))).select(
        block, F.lit(True).alias("asks"), "node", "n", "component", F.col("␟lookups").alias("lookups"), none("into"), none("part"),
        *[none(c, "array<bigint>") for c in ("met", "low", "high", "room")])
    groups = as_one.join(asked, home).withColumn("turn", F.pmod(F.xxhash64("into", "part"), "turns")).select(
        block, F.lit(False).alias("asks"), *[none(c) for c in ("node", "n", "component")], none("lookups", "array<bigint>"), "into", "part",
        F.col("entries.shingle").alias("met"), *[F.col(f"entries.{c}").alias(c) for c in ("low", "high", "room")])
    met_in = members.unionByName(groups).repartition("block").sortWithinPartitions("block")
    together = met_in.mapInArrow(_asking, ", ".join(f"{c} bigint" for c in FOUND))
    return stored(by_itself.unionByName(together), "shingle-lookups")


def _across(docs: DataFrame, text: str, nodes: DataFrame, known: DataFrame, found: DataFrame) -> DataFrame:
    """Links between components, from opening the groups that were found."""
    asked = found.groupBy("into", "part").agg(F.count("*").alias("n"), F.sum("n").alias("size"))
    turns = F.ceil(F.greatest(F.col("n") / QUERIES, F.col("size") / QUERY_SHINGLES)).cast("bigint")
    asked = stored(asked.select("into", "part", turns.alias("turns")), "shingle-asked")
    block = F.xxhash64("into", "part", "turn").alias("block")
    members = asked.join(known.select("into", "part", "node", "component"), ["into", "part"], "left")
    members = members.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns") - 1))).select(
        block, F.coalesce("node", "into").alias("node"), F.coalesce("component", "into").alias("component"), F.lit(False).alias("asks"))
    queries = found.join(asked, ["into", "part"]).withColumn("turn", F.pmod(F.xxhash64("node"), "turns")).select(block, "node", "component", F.lit(True).alias("asks"))
    roles = stored(members.unionByName(queries), "shingle-roles")
    sets = _sets(docs, text, nodes, roles, "shingle-sets")
    halves = F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int")).alias("halves")
    bounded = roles.join(sets.select("node", halves), "node").select("block", "node", "asks", "halves")
    bounded = stored(bounded.repartition("block").sortWithinPartitions("block").mapInArrow(_qualified, "block bigint, node bigint"), "shingle-qualified")
    members = roles.where(~F.col("asks")).join(bounded.select("block").distinct(), "block", "left_semi")
    queries = roles.where("asks").join(bounded, ["block", "node"], "left_semi")
    opened = members.unionByName(queries).join(sets, "node").select("block", "component", "asks", "shingles")
    return stored(opened.repartition("block").sortWithinPartitions("block").mapInArrow(_opened, "a bigint, b bigint"), "shingle-links")


def link_documents(docs: DataFrame, *, id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``n_shingles`` and ``component_id``, the least id that links reach."""
    made = {"n_shingles", "component_id"}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    shingles = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, text=text))
    source = docs.select(*[named(c) for c in kept], named(id).alias("␟id"), F.monotonically_increasing_id().alias(_ROW), named(text).cast("string").alias("␟body"))
    base = stored(annotate(source, "␟body", FIELDS, _signed(shingles), [*kept, "␟id", _ROW]), "shingle-base")
    worded = base.where("`␟key` is not null")
    nodes = worded.groupBy("␟key").agg(
        F.min(_ROW).alias("node"), F.min("␟id").alias("least"), F.first("␟lots").alias("␟lots"), F.min("n_shingles").alias("n_shingles"), F.count("*").alias("copies"))
    nodes = stored(nodes, "shingle-nodes")

    lots, member = _lots(nodes)
    links = _within_lots(docs, text, nodes, lots, member)
    labels = nodes.where("false").select("node", F.col("node").alias("component")) if links.isEmpty() else components(links, "shingle-inner")
    known = _grouped(nodes, member, labels)

    found = _lookup(base, known)
    across = None if found.isEmpty() else _across(docs, text, nodes, known, found)
    whole = nodes.select("␟key", "node", "least").join(labels.select("node", "component"), "node", "left").select("␟key", "least", F.coalesce("component", "node").alias("component"))
    if across is not None and not across.isEmpty():
        joined = components(across, "shingle-across").select(F.col("node").alias("component"), F.col("component").alias("root"))
        whole = whole.join(joined, "component", "left").select("␟key", "least", F.coalesce("root", "component").alias("component"))
    whole = stored(whole, "shingle-whole")
    least = stored(whole.groupBy("component").agg(F.min("least").alias("component_id")), "shingle-least")
    named_by = stored(whole.join(least, "component").select("␟key", "component_id"), "shingle-named")

    own = [named(c) for c in kept]
    linked = worded.join(named_by, "␟key").select(*own, "n_shingles", "component_id")
    return linked.unionByName(base.where("`␟key` is null").select(*own, "n_shingles", F.col("␟id").alias("component_id")))
