"""Graph tables on plain parquet: an append-only change log and folded versions.

    <root>/log/batch_id=<n>/place=<source.db.table>/   changes of micro-batch n, once for each table
    <root>/commits/<n>.<owner>                         batch n is complete, and who wrote it
    <root>/base/<kind>-<label>/upto-<n>.gen-<g>.buckets-<b>/   all changes up to batch n, folded
    <root>/marks/<n>.<place>                       low mark of a source, set after batch n

A change is logged once, however many labels read its table, and routed when it
is read: a label added later finds what its table has logged.  Writing a batch
again replaces it.  A reader sees whole batches only, the same ones for every
label.  The folded version is bucketed by the key (an edge without a rank: by
its two ends), so folding newer changes into it shuffles those changes but not
the version.  Deletes stay in it as tombstones, or an older change that arrives
late would bring a key back; they go when a low mark says that none can arrive.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from graphtide.operators import fold, project, route, verify
from graphtide.plans.spec import DELETED, DST, OP, RANK, SEQ, SRC, VID, GraphSpec, Label, quoted
from graphtide.sources.envelopes import ENVELOPE, SEQ_TYPE, data_envelope, seq_of
from graphtide.sources.snapshot import snapshot_rows
from graphtide.streaming.files import Files, byte_count, join, session_setting

REJECTED = "_rejected"
LOG_DDL = (
    f"op string, seq {SEQ_TYPE}, `key` array<string>, {ENVELOPE} string, parse_time bigint, "
    "source string, db string, `table` string, reason string, place string, batch_id bigint"
)
LOG_COLUMNS = ("op", "seq", "key", ENVELOPE, "parse_time", "source", "db", "table", "reason", "place")
EMPTY_FEED_DDL = (
    f"op string, seq {SEQ_TYPE}, `key` array<string>, {ENVELOPE} string, parse_time bigint, "
    "source string, db string, `table` string"
)
_VERSION = re.compile(r"upto-(\d+)\.gen-(\d+)\.buckets-(\d+)$")
_BUCKET_FILE = re.compile(r".*_(\d+)(?:\..*)?$")  # how Spark names the files of a bucket
ANYONE = "manual"
CODEC = "zstd"  # envelope text repeats its names: half the size of Spark's default
OPEN_TABLES = 16  # files that a task writing the log keeps open; it sorts the rows of further tables
LOG_BLOCK = 32 << 20  # what such a file holds back in memory


class Version(NamedTuple):
    """A folded version; a later generation of the same batches replaces an earlier one."""

    upto: int
    generation: int
    buckets: int

    @property
    def folder(self) -> str:
        return f"upto-{self.upto}.gen-{self.generation}.buckets-{self.buckets}"


class GraphStore:
    """Vertex and edge tables below ``root``.

    Batches are numbered from 0; number 0 is kept for a snapshot.

    ``buckets`` is the number of files of a folded version (default: the
    session's shuffle partitions); choose it so that one holds a few hundred
    megabytes.  A batch writes up to ``log_files`` files for one table, and more only where
    they have a sixteenth of ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` or more each.
    ``keep_rejects`` also logs the changes that reach no label.  One writer
    (streaming query) feeds a store.
    """

    def __init__(self, spark: SparkSession, root: str, spec: GraphSpec, *, buckets: int | None = None,
                 keep_rejects: bool = False, log_files: int = 8) -> None:
        self.spark, self.root, self.spec = spark, root, spec
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.keep_rejects, self.log_files = keep_rejects, log_files
        self.files = Files(spark)

    # -- writing ---------------------------------------------------------------

    def append(self, feed: DataFrame, batch_id: int, owner: str = ANYONE) -> None:
        """Log a batch of decoded envelopes under its number.

        Repeating a number replaces its batch, so a replay after a failure leaves
        no trace; one that is folded already is not written again.  A number that
        another owner has written, or a new one that a version would hide, is
        refused.
        """
        before = self._owners().get(batch_id)
        if before not in (None, owner):
            raise ValueError(f"batch {batch_id} belongs to {before!r}, not to {owner!r}")
        if batch_id <= self.folded():
            if before is None:
                raise ValueError(f"batch {batch_id} would not be read: versions hold the batches up to {self.folded()}")
            return
        self._append(feed, batch_id, owner)

    def _append(self, feed: DataFrame, batch_id: int, owner: str) -> None:
        path = join(self.root, "log", f"batch_id={batch_id}")
        marker = join(self.root, "commits", f"{batch_id}.{owner}")
        self.files.remove(marker)  # while it is rewritten, the batch is not complete
        self._write_log(self._logged(feed), path, "overwrite")
        self._merge_small(path)
        self.files.mark(marker)

    @staticmethod
    def _write_log(rows: DataFrame, path: str, mode: str) -> None:
        """Write rows where they are: neither a shuffle nor a sort puts the text of a batch on disk a second time."""
        with session_setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_TABLES)):
            writer = rows.write.mode(mode).option("compression", CODEC).option("parquet.block.size", LOG_BLOCK)
            writer.partitionBy("place").parquet(path)

    def _merge_small(self, path: str) -> None:
        """Write the files of a table anew where a batch left many small ones; the batch is not complete yet."""
        target = byte_count(self.spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
        merged: dict[int, list[str]] = {}
        for place in (n for n in self.files.names(path) if n.startswith("place=")):
            count, size = self.files.content(join(path, place))
            if count > self.log_files and size < count * target / 16:
                merged.setdefault(max(self.log_files, -(-size // target)), []).append(join(path, place))
        for files, places in merged.items():
            small = [join(place, n) for place in places for n in self.files.names(place)]
            rows = self.spark.read.schema(LOG_DDL).option("basePath", join(self.root, "log")).parquet(*small)
            self._write_log(rows.select(*LOG_COLUMNS).coalesce(files), path, "append")
            for file in small:
                self.files.remove(file)

    def folded(self) -> int:
        """The last batch that some version holds, -1 without versions."""
        return max((v.upto for label in self.spec.distinct() for v in self.versions(label)), default=-1)

    def load_snapshot(self, label: Label | str, tables: DataFrame | Mapping[Label, DataFrame]) -> None:
        """Make the rows of a source table the first version of a label, as batch 0.

        Typed rows go straight into the buckets: one shuffle and no JSON.  Use
        it for large tables before the stream starts; a table that feeds several
        labels is loaded once for each.  A label that several tables feed gets
        them all at once, as ``{mapping: table}``.
        """
        label = self._label(label)
        if self.versions(label):
            raise ValueError(f"{label.label} has a version already")
        tables = tables if isinstance(tables, Mapping) else {label: tables}
        found = [snapshot_rows(table, mapping) for mapping, table in tables.items()]
        rows = fold.latest_changes(reduce(DataFrame.unionByName, found), label)
        self._write(rows.repartition(self.buckets, *self._identity(label)), label, Version(0, 0, self.buckets))
        if 0 not in self.batches():
            self._append(self.spark.createDataFrame([], EMPTY_FEED_DDL), 0, ANYONE)

    def set_low_mark(self, source: str, seq: Mapping) -> None:
        """No change of ``source`` from before ``seq`` will come after the batches that are complete now.

        ``seq`` has ``ts_sec`` and, if the changes have them, ``file, pos, row``: a mark without
        a file stands before every change that has one.  The next
        ``compact`` leaves out the tombstones before the first mark of a label's sources
        (all of them must have one).  A change that comes all the same, in a later batch, is
        not read; ``rejects`` shows it as ``too_late``.  Marks stay.
        """
        if source not in {m.source for m in self.spec.labels}:
            raise ValueError(f"{source!r} feeds no label")
        place = json.dumps([source, *(seq.get(p) for p in ("ts_sec", "file", "pos", "row"))]).encode().hex()
        self.files.mark(join(self.root, "marks", f"{max(self.batches(), default=-1)}.{place}"))

    def _marks(self, source: str) -> list[tuple[int, Column]]:
        """Low marks of a source, each with the last batch that may hold older changes."""
        found = []
        for name in self.files.names(join(self.root, "marks")):
            batch, _, place = name.partition(".")
            of, ts_sec, file, pos, row = json.loads(bytes.fromhex(place))
            if of == source:
                parts = (None if v is None else F.lit(v) for v in (pos, row, file))
                found.append((int(batch), seq_of(F.lit(ts_sec), *parts)))
        return found

    def _too_late(self, source: str) -> Column:
        """Whether a logged change comes from before a low mark that was set before its batch."""
        late = F.lit(False)
        for batch, mark in self._marks(source):
            late = late | ((F.col("batch_id") > batch) & fold.before(F.col("seq"), mark))
        return late

    def _retired(self, latest: DataFrame, label: Label) -> DataFrame:
        marks = [[m for _, m in self._marks(source)] for source in {m.source for m in self.spec.mappings(label)}]
        if not all(marks):
            return latest
        return fold.without_old_tombstones(latest, fold.first_of([fold.last_of(of) for of in marks]))

    def _logged(self, feed: DataFrame) -> DataFrame:
        if ENVELOPE not in feed.columns:
            data = F.col("data") if dict(feed.dtypes)["data"] == "string" else F.to_json("data")
            feed = feed.withColumn(ENVELOPE, data_envelope(data))
        judged = route.judge_tables(feed, self.spec)
        if not self.keep_rejects:
            judged = judged.where("reason IS NULL")
        place = F.when(F.col("reason").isNull(), F.concat_ws(".", "source", "db", "table")).otherwise(REJECTED)
        return judged.withColumn("place", place).select(*LOG_COLUMNS)

    # -- reading ---------------------------------------------------------------

    def _owners(self) -> dict[int, str]:
        """Complete batches and who wrote them."""
        names = (n.partition(".") for n in self.files.names(join(self.root, "commits")))
        return {int(n): owner for n, _, owner in names if n.isdigit()}

    def batches(self) -> list[int]:
        """Numbers of the complete batches."""
        return sorted(self._owners())

    def _log(self, place: str, after: int, upto: int | None = None) -> DataFrame | None:
        log = join(self.root, "log")
        there = {int(n.removeprefix("batch_id=")) for n in self.files.names(log) if n.startswith("batch_id=")}
        paths = [join(log, f"batch_id={n}") for n in self.batches() if n > after and n in there and (upto is None or n <= upto)]
        if not paths:
            return None
        reader = self.spark.read.schema(LOG_DDL).option("basePath", log)
        return reader.parquet(*paths).where(F.col("place") == place)

    def rejects(self) -> DataFrame:
        """Logged changes that do not reach a label, with the reason and the label.

        What no label reads is there if the store keeps rejects.  A change with a
        value of the wrong type (``bad_value``) or without its key (``null_key``) is
        found anew from the log.  ``vacuum`` moves the rejects of the batches that it
        drops to a table of their own if the store keeps rejects.
        """
        kept = self._reject_tables()
        found = self._found_rejects(max(kept, default=-1))
        for upto in kept:
            found = found.unionByName(self.spark.read.schema(found.schema).parquet(join(self.root, "rejects", f"upto-{upto}")))
        return found

    def _reject_tables(self) -> list[int]:
        """Last batches of the tables of moved rejects."""
        home = join(self.root, "rejects")
        return sorted(int(n.removeprefix("upto-")) for n in self.files.names(home) if self.files.exists(join(home, n, "_SUCCESS")))

    def _found_rejects(self, after: int, upto: int | None = None) -> DataFrame:
        shown = ["reason", "label", ENVELOPE, "op", "seq", "source", "db", "table"]
        found = self._log(REJECTED, after, upto)
        if found is None:
            return self.spark.createDataFrame([], f"label string, {LOG_DDL}").select(*shown)
        found = found.withColumn("label", F.lit(None).cast("string")).select(*shown)
        for mapping in self.spec.labels:
            home = (F.col("source") == mapping.source) & (F.col("db") == mapping.db) & (F.col("table") == mapping.table)
            logged = self._log(mapping.place, after, upto).where(home & route.op_class(F.col("op")).isNotNull())
            spoiled = project.rejected_slots(project.project_slots(logged, mapping, carry=[ENVELOPE, "op", "seq", "source", "db", "table"]), mapping)
            found = found.unionByName(spoiled.withColumn("label", F.lit(mapping.label)).select(*shown))
            late = logged.where(self._too_late(mapping.source)).withColumn("reason", F.lit("too_late"))
            found = found.unionByName(late.withColumn("label", F.lit(mapping.label)).select(*shown))
        return found

    def changes(self, label: Label | str, *, after: int = -1) -> DataFrame:
        """Change rows of a label from the batches after a given one."""
        parts = [self._mapping_changes(m, after) for m in self._mappings(self._label(label))]
        return reduce(DataFrame.unionByName, parts)

    def _mappings(self, label: Label) -> list[Label]:
        found = self.spec.mappings(label)
        return found if label.props else [m.bare() if m.props else m for m in found]

    def _mapping_changes(self, mapping: Label, after: int) -> DataFrame:
        logged = self._log(mapping.place, after)
        if logged is None:
            ddl = f"{project.change_ddl(mapping)}, {OP} string, {SEQ} {SEQ_TYPE}"
            return self.spark.createDataFrame([], ddl)
        # Names may hold dots, so different tables may share a place.
        home = (F.col("source") == mapping.source) & (F.col("db") == mapping.db) & (F.col("table") == mapping.table)
        logged = logged.where(home & route.op_class(F.col("op")).isNotNull() & ~self._too_late(mapping.source))
        return project.map_columns(project.project_slots(logged, mapping), mapping)

    def versions(self, label: Label | str) -> list[Version]:
        """Complete folded versions, oldest first."""
        home = self._home(self._label(label))
        found = [_VERSION.match(n) for n in self.files.names(home)]
        return sorted(Version(*map(int, m.groups())) for m in found if m and self.files.exists(join(home, m[0], "_SUCCESS")))

    def _identity(self, label: Label) -> list[str]:
        """The key columns that tell vertices or edges apart: not a rank that no mapping fills."""
        ranked = any(m.keys.get(RANK) is not None for m in self.spec.mappings(label))
        return [n for n in label.key_names if n != RANK or ranked]

    def latest(self, label: Label | str) -> DataFrame:
        """Newest change of every key, tombstones included."""
        label = self._label(label)
        versions = self.versions(label)
        if not versions:
            return fold.latest_changes(self.changes(label), label)
        base = self._version(label, versions[-1]).select(*fold.state_columns(label), SEQ, DELETED)
        if not self._newer(versions[-1].upto):
            return base
        tail = fold.latest_changes(self.changes(label, after=versions[-1].upto), label)
        # The join takes the partitioning of its finer side.  Cut the folded tail like the
        # version, whatever the session's shuffle partitions, so that it is the tail that moves.
        identity = self._identity(label)
        return fold.merge_latest(base, tail.repartition(versions[-1].buckets, *identity), label, identity)

    def state(self, label: Label | str) -> DataFrame:
        """Current vertices or edges of a label."""
        label = self._label(label)
        return fold.alive(self.latest(label), label)

    def live_keys(self, label: Label | str) -> DataFrame:
        """Keys of the current vertices or edges; properties are neither parsed nor shuffled."""
        return self.state(self._label(label).bare())

    def lookup(self, label: Label | str, ids: DataFrame) -> DataFrame:
        """Vertices by ``_vid``; only the requested keys are folded."""
        return self._narrowed(self._label(label), ids, [VID])

    def fetch(self, label: Label | str, pairs: DataFrame) -> DataFrame:
        """Edges by ``(_src, _dst)``; only the requested keys are folded."""
        return self._narrowed(self._label(label), pairs, [SRC, DST])

    def one_hop(self, label: Label | str, seeds: DataFrame) -> DataFrame:
        """Out-neighbours of the seeds (column ``_src``): keys of the edges, properties neither parsed nor moved."""
        return self._narrowed(self._label(label).bare(), seeds, [SRC])

    def _narrowed(self, label: Label, wanted: DataFrame, on: list[str]) -> DataFrame:
        """Current rows whose ``on`` columns are among ``wanted``.

        Where these are what the version is bucketed by, only the buckets that a key of
        the request can be in are read; a request that touches them all is cut like the
        version, which stays where it is.  Else (a source alone, or a ranked edge by its
        ends) a small request is broadcast and a large one makes both sides move, split
        where skewed.
        """
        wanted = wanted.select(*[F.col(c).cast(label.shape[c]).alias(c) for c in on]).distinct()
        versions = self.versions(label)
        newer = self.changes(label, after=versions[-1].upto if versions else -1)
        rows = fold.with_deleted(newer.join(wanted, on, "left_semi"))
        if versions:
            asked, touched = wanted, None
            if on == self._identity(label):
                touched = self.touched(wanted, on, versions[-1])
                if len(touched) == versions[-1].buckets:
                    asked, touched = wanted.repartition(versions[-1].buckets, *on), None
            base = self._version(label, versions[-1], touched).select(*rows.columns)
            rows = rows.unionByName(base.join(asked, on, "left_semi"))
        return fold.current_state(rows, label)

    @staticmethod
    def touched(wanted: DataFrame, on: list[str], version: Version) -> list[int]:
        """Numbers of the buckets that the wanted keys fall into, at most as many as there are buckets.

        A job over the request alone; Spark deals keys to buckets by this very hash.
        """
        bucket = F.pmod(F.hash(*on), F.lit(version.buckets)).alias("bucket")
        return sorted(r["bucket"] for r in wanted.select(bucket).distinct().collect())

    def stats(self) -> DataFrame:
        """Rows per label and totals of each space."""
        return verify.graph_stats(
            {(v.space, v.label): self.live_keys(v) for v in self.spec.distinct("vertex")},
            {(e.space, e.label): self.live_keys(e) for e in self.spec.distinct("edge")},
        )

    # -- maintenance -----------------------------------------------------------

    def compact(self, label: Label | str) -> int | None:
        """Fold all complete batches into a new version; returns its last batch."""
        label = self._label(label)
        done = self.batches()
        versions = self.versions(label)
        if not done or (versions and versions[-1].upto >= done[-1]):
            return versions[-1].upto if versions else None
        latest = self._retired(self.latest(label), label)
        buckets = versions[-1].buckets if versions else self.buckets
        if not versions:
            # Later versions come out of the join in bucket order already.
            latest = latest.repartition(buckets, *self._identity(label))
        self._write(latest, label, Version(done[-1], 0, buckets))
        return done[-1]

    def compact_all(self) -> None:
        for label in self.spec.distinct():
            self.compact(label)

    def rebucket(self, label: Label | str, buckets: int) -> None:
        """Rewrite the newest version with another number of buckets, as its next generation."""
        label = self._label(label)
        last = self.versions(label)[-1]
        if buckets == last.buckets:
            raise ValueError(f"{label.label} has {buckets} buckets already")
        latest = self._version(label, last).select(*fold.state_columns(label), SEQ, DELETED)
        self._write(latest.repartition(buckets, *self._identity(label)), label, Version(last.upto, last.generation + 1, buckets))

    def vacuum(self) -> None:
        """Delete superseded versions and the batches every label has folded.

        Readers that started before must have finished.
        """
        folded = [self.versions(x) for x in self.spec.distinct()]
        for label, versions in zip(self.spec.distinct(), folded):
            for version in versions[:-1]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(label, version)}")
                self.files.remove(join(self._home(label), version.folder))
        oldest = min((v[-1].upto for v in folded if v), default=-1) if all(folded) else -1
        moved = max(self._reject_tables(), default=-1)
        if self.keep_rejects and moved < oldest:
            # Complete before a batch goes; from then on these batches are not searched again.
            self._found_rejects(moved, oldest).write.mode("overwrite").parquet(join(self.root, "rejects", f"upto-{oldest}"))
        for batch, owner in sorted(self._owners().items()):
            if batch <= oldest:
                # The marker of the newest folded batch stays: it dates the store.
                if batch < oldest:
                    self.files.remove(join(self.root, "commits", f"{batch}.{owner}"))
                self.files.remove(join(self.root, "log", f"batch_id={batch}"))

    # -- helpers ---------------------------------------------------------------

    def _label(self, label: Label | str) -> Label:
        return self.spec.label(label) if isinstance(label, str) else label

    def _newer(self, upto: int) -> bool:
        return any(n > upto for n in self.batches())

    def _home(self, label: Label) -> str:
        return join(self.root, "base", f"{label.kind}-{label.label}")

    def _table(self, label: Label, version: Version) -> str:
        """Catalog name of a version; the catalog is what tells Spark about the buckets."""
        place = hashlib.sha256(join(self._home(label), version.folder).encode()).hexdigest()
        plain = re.sub(r"\W", "_", label.label).lower()
        return f"graphtide_{plain}_{place}"

    def _version(self, label: Label, version: Version, buckets: list[int] | None = None) -> DataFrame:
        """A version with the columns of the label as mapped now: one that it was written without is null.

        With ``buckets``, only the files of these are read.
        """
        table = self._table(label, version)
        path = join(self._home(label), version.folder)
        full = self.spec.mappings(label)[0]  # a bare label reads the same files
        if not self.spark.catalog.tableExists(table):
            written = self.spark.read.parquet(path).schema
            identity = ", ".join(self._identity(label))
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in written.fields)
            place = path.replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
                f"CLUSTERED BY ({identity}) SORTED BY ({identity}) INTO {version.buckets} BUCKETS LOCATION '{place}'"
            )
        found = self.spark.table(table)
        if buckets is not None:
            named = ((_BUCKET_FILE.match(n), n) for n in self.files.names(path))
            chosen = [join(path, n) for m, n in named if m and int(m[1]) in set(buckets)]
            schema = found.schema
            found = self.spark.read.schema(schema).parquet(*chosen) if chosen else self.spark.createDataFrame([], schema)
        kinds = dict(found.dtypes)
        changed = sorted(n for n in label.key_names if kinds[n] != _simple(full.shape[n]))
        if changed:
            raise ValueError(f"{label.label}: the type of {changed} is not that of the folded version; load the label anew")
        props = {n: t for n, t in full.shape.items() if n not in full.key_names}
        shown = [F.col(quoted(n)).cast(t) if n in kinds else F.lit(None).cast(t) for n, t in props.items()]
        return found.select(*label.key_names, *[c.alias(n) for c, n in zip(shown, props)], SEQ, DELETED)

    def _write(self, latest: DataFrame, label: Label, version: Version) -> None:
        table = self._table(label, version)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        identity = self._identity(label)
        # Else the shuffle of a fold stays on disk until the driver collects its garbage.
        with session_setting(latest.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            (
                latest.write.format("parquet").mode("overwrite").option("compression", CODEC)
                .bucketBy(version.buckets, *identity).sortBy(*identity)
                .option("path", join(self._home(label), version.folder)).saveAsTable(table)
            )


def _simple(ddl: str) -> str:
    return DataType.fromDDL(ddl).simpleString()
