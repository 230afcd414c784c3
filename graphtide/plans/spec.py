"""Mapping specification: which source table feeds which vertex or edge label.

A spec is a small driver-side object.  It is validated once, when it is built,
and then only supplies column names, schemas and routes to the DataFrame
operators; nothing in here runs a Spark job.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields, replace

# Control and key columns of every change and state table.  A property may not
# use one of these names.
VID, SRC, DST, RANK = "_vid", "_src", "_dst", "_rank"
SEQ, OP, DELETED = "_seq", "_op", "_deleted"
RESERVED = (VID, SRC, DST, RANK, SEQ, OP, DELETED)


def quoted(name: str) -> str:
    """Column name as a SQL identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


class SpecError(ValueError):
    """The mapping cannot be used as written."""


# Type of a column the mapping does not declare: whatever the record holds, as
# text.  Numbers are exact up to 38 digits; declare ``string`` for columns that
# hold text anyway, that is cheaper.
AUTO = "auto"


@dataclass(frozen=True)
class Prop:
    """Property ``name`` filled from source column ``column``."""

    name: str
    column: str
    type: str = AUTO
    position: int | None = None


@dataclass(frozen=True)
class KeyRef:
    """Source column that supplies an id, a source, a destination or a rank."""

    column: str
    type: str = AUTO
    position: int | None = None


@dataclass(frozen=True)
class Label:
    """Common part of a vertex and an edge mapping."""

    name: str
    space: str
    db: str
    table: str
    props: tuple[Prop, ...] = ()
    source: str = "default"

    @property
    def label(self) -> str:
        return f"{self.space}.{self.name}"

    @property
    def kind(self) -> str:
        raise NotImplementedError

    @property
    def keys(self) -> dict[str, KeyRef | None]:
        """Output key column -> where it comes from (None: constant 0)."""
        raise NotImplementedError

    @property
    def key_names(self) -> list[str]:
        return list(self.keys)

    @property
    def prop_names(self) -> list[str]:
        return [p.name for p in self.props]

    @property
    def index_columns(self) -> list[str]:
        """Source columns that identify the vertex or edge, without repeats."""
        return list(dict.fromkeys(k.column for k in self.keys.values() if k is not None))

    @property
    def slots(self) -> list[str]:
        """Source columns in slot order.

        Properties come first in list order; each key column that no property
        uses is then inserted at its configured position (default: the front).
        """
        slots = [p.column for p in self.props]
        for at, key in enumerate(k for k in self.keys.values() if k is not None):
            if key.column in slots:
                continue
            position = min(at, len(slots)) if key.position is None else key.position
            if not 0 <= position <= len(slots):
                raise SpecError(
                    f"{self.label}: key column {key.column!r} has position {position}, "
                    f"but only {len(slots)} slots exist"
                )
            slots.insert(position, key.column)
        return slots

    @property
    def column_types(self) -> dict[str, str]:
        """Declared type of every source column the label reads."""
        types: dict[str, str] = {}
        refs = [*(k for k in self.keys.values() if k is not None), *self.props]
        for ref in refs:
            known = types.get(ref.column, AUTO)
            if AUTO not in (known, ref.type) and known != ref.type:
                raise SpecError(
                    f"{self.label}: column {ref.column!r} is declared both {known!r} and {ref.type!r}"
                )
            types[ref.column] = ref.type if known == AUTO else known
        return types

    def type_of(self, column: str) -> str:
        """SQL type a source column has in vertices and edges."""
        declared = self.column_types[column]
        return "string" if declared == AUTO else declared

    @property
    def data_ddl(self) -> str:
        """Schema to parse the row image with: mapped columns only, in slot order."""
        types = self.column_types
        parsed = {c: "variant" if types[c] == AUTO else types[c] for c in self.slots}
        return ", ".join(f"{quoted(c)}: {t}" for c, t in parsed.items())

    @property
    def shape(self) -> dict[str, str]:
        """Columns of the vertices or edges and their types."""
        keys = {n: "bigint" if n == RANK else self.type_of(r.column) for n, r in self.keys.items()}
        return keys | {p.name: self.type_of(p.column) for p in self.props}

    @property
    def route(self) -> str:
        """Name of this mapping among all: what it feeds and where it reads."""
        return f"{self.kind}-{self.label}@{self.source}.{self.db}.{self.table}"

    @property
    def place(self) -> str:
        """Name of the source table."""
        return f"{self.source}.{self.db}.{self.table}"

    def bare(self) -> Label:
        """The label without its properties, for work that only needs to know what exists.

        Records are then parsed for their key columns alone, and only those are
        shuffled.
        """
        names = {f.name for f in fields(self)} - {f.name for f in fields(Label)}
        types = self.column_types
        refs = {n: getattr(self, n) for n in names}
        keys = {n: ref and KeyRef(ref.column, types[ref.column]) for n, ref in refs.items()}
        return replace(self, props=(), **keys)

    def validate(self) -> None:
        for what, value in (("name", self.name), ("space", self.space), ("source", self.source),
                            ("db", self.db), ("table", self.table)):
            if not value:
                raise SpecError(f"mapping {self.name!r} has no {what}")
        for role, key in self.keys.items():
            if key is not None and not key.column:
                raise SpecError(f"{self.label}: key {role} names no column")
        names = [n.lower() for n in self.prop_names]
        clash = sorted({n for n in names if names.count(n) > 1} | (set(names) & set(RESERVED)))
        if clash:
            raise SpecError(f"{self.label}: property names repeated or reserved: {clash}")
        self.column_types  # raises on conflicting types
        slots = self.slots
        for ref in (*self.props, *(k for k in self.keys.values() if k is not None)):
            if ref.position is None:
                continue
            found = slots[ref.position] if 0 <= ref.position < len(slots) else None
            if found != ref.column:
                raise SpecError(
                    f"{self.label}: column {ref.column!r} is configured at position {ref.position}, "
                    f"which holds {found!r} (slots: {slots})"
                )


@dataclass(frozen=True)
class VertexMap(Label):
    id: KeyRef = KeyRef("")

    @property
    def kind(self) -> str:
        return "vertex"

    @property
    def keys(self) -> dict[str, KeyRef | None]:
        return {VID: self.id}


@dataclass(frozen=True)
class EdgeMap(Label):
    src: KeyRef = KeyRef("")
    dst: KeyRef = KeyRef("")
    rank: KeyRef | None = None

    @property
    def kind(self) -> str:
        return "edge"

    @property
    def keys(self) -> dict[str, KeyRef | None]:
        return {SRC: self.src, DST: self.dst, RANK: self.rank}


@dataclass(frozen=True)
class GraphSpec:
    vertices: tuple[VertexMap, ...] = ()
    edges: tuple[EdgeMap, ...] = ()
    sources: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        seen: set[tuple[str, ...]] = set()
        for label in self.labels:
            label.validate()
            ident = (label.kind, label.label, label.source, label.db, label.table)
            if ident in seen:
                raise SpecError(f"{label.kind} {label.label} is mapped twice from {label.db}.{label.table}")
            seen.add(ident)
            if self.sources and label.source not in self.sources:
                raise SpecError(
                    f"{label.label} reads source {label.source!r}, which is not among {list(self.sources)}"
                )
            first = self.mappings(label)[0]
            if label.shape != first.shape:
                raise SpecError(
                    f"the mappings of {label.kind} {label.label} differ in keys, properties or types: "
                    f"{first.shape} and {label.shape}"
                )

    @property
    def labels(self) -> list[Label]:
        """All mappings; a label that several tables feed occurs once for each."""
        return [*self.vertices, *self.edges]

    def mappings(self, label: Label) -> list[Label]:
        """All mappings that feed the same vertex or edge label."""
        return [x for x in self.labels if (x.kind, x.label) == (label.kind, label.label)]

    def distinct(self, kind: str | None = None) -> list[Label]:
        """One mapping of every label, optionally of one kind."""
        first = {(x.kind, x.label): x for x in reversed(self.labels)}
        return [x for x in reversed(first.values()) if kind in (None, x.kind)]

    def label(self, name: str) -> Label:
        """A mapping of the label ``space.name`` or, when that is unique, ``name``."""
        hits = [x for x in self.distinct() if name in (x.label, x.name)]
        if len(hits) != 1:
            raise SpecError(f"{name!r} matches {len(hits)} labels of {[x.label for x in self.distinct()]}")
        return hits[0]

    def captured_tables(self) -> dict[str, list[str]]:
        """Source name -> sorted ``db.table`` names that some label reads."""
        out: dict[str, set[str]] = {}
        for label in self.labels:
            out.setdefault(label.source, set()).add(f"{label.db}.{label.table}")
        return {source: sorted(tables) for source, tables in sorted(out.items())}


def _key(block: Mapping | None, where: str, *, optional: bool = False) -> KeyRef | None:
    column = (block or {}).get("sqlCol")
    if not column:
        if optional:
            return None
        raise SpecError(f"{where} is missing or names no sqlCol")
    return KeyRef(column, block.get("type", AUTO), block.get("position"))


def _common(block: Mapping) -> dict:
    try:
        return dict(
            name=block["sinkName"],
            space=block["graphSpace"],
            source=block["sourceSql"],
            db=block["sourceDatabase"],
            table=block["sourceTable"],
            props=tuple(
                Prop(f["name"], f["sqlCol"], f.get("type", AUTO), f.get("position"))
                for f in block.get("fieldList") or ()
            ),
        )
    except KeyError as missing:
        raise SpecError(f"mapping {block.get('sinkName', '?')!r} lacks {missing}") from None


def spec_from_dict(doc: Mapping) -> GraphSpec:
    """Build a spec from the configuration layout used by existing mapping files.

    The mapping block is the top-level entry that holds ``tagList`` and/or
    ``edgeList``; an absent list is empty.  Service addresses and credentials in
    the file are ignored: connection options are given when a source is read.
    """
    blocks = [v for v in doc.values() if isinstance(v, Mapping) and ("tagList" in v or "edgeList" in v)]
    if len(blocks) != 1:
        raise SpecError(f"expected one block with tagList/edgeList, found {len(blocks)}")
    sources = tuple(s["sqlName"] for s in doc.get("mysqlSourceInList") or ())
    vertices = tuple(
        VertexMap(**_common(b), id=_key(b.get("idIndex"), f"{b.get('sinkName')}: idIndex"))
        for b in blocks[0].get("tagList") or ()
    )
    edges = tuple(
        EdgeMap(
            **_common(b),
            src=_key(b.get("srcIndex"), f"{b.get('sinkName')}: srcIndex"),
            dst=_key(b.get("dstIndex"), f"{b.get('sinkName')}: dstIndex"),
            rank=_key(b.get("rankIndex"), f"{b.get('sinkName')}: rankIndex", optional=True),
        )
        for b in blocks[0].get("edgeList") or ()
    )
    return GraphSpec(vertices, edges, sources)


def load_spec(path: str) -> GraphSpec:
    """Read a mapping file: JSON, or YAML where a YAML parser is installed."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return spec_from_dict(json.loads(text))
    try:
        import yaml
    except ImportError as missing:
        raise SpecError("reading a YAML mapping needs the yaml package; use JSON instead") from missing
    return spec_from_dict(yaml.safe_load(text))


def with_types(spec: GraphSpec, types: Mapping[str, Mapping[str, str]]) -> GraphSpec:
    """Declare column types, given as ``{'db.table': {column: type}}``.

    Mapping files need not carry types; their columns are text then.
    """
    def typed(ref, columns):
        return None if ref is None else replace(ref, type=columns.get(ref.column, ref.type))

    def columns_of(label: Label) -> Mapping[str, str]:
        return types.get(f"{label.db}.{label.table}", {})

    def props(label: Label) -> tuple[Prop, ...]:
        return tuple(typed(p, columns_of(label)) for p in label.props)

    return GraphSpec(
        tuple(replace(v, props=props(v), id=typed(v.id, columns_of(v))) for v in spec.vertices),
        tuple(
            replace(e, props=props(e), src=typed(e.src, columns_of(e)), dst=typed(e.dst, columns_of(e)),
                    rank=typed(e.rank, columns_of(e)))
            for e in spec.edges
        ),
        spec.sources,
    )


def spec_labels(labels: Iterable[Label], sources: Iterable[str] = ()) -> GraphSpec:
    labels = list(labels)
    return GraphSpec(
        tuple(x for x in labels if isinstance(x, VertexMap)),
        tuple(x for x in labels if isinstance(x, EdgeMap)),
        tuple(sources),
    )
