"""Raw change records as connectors emit them: before/after images and an offset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtide.plans.spec import quoted

OFFSET_TYPE = "struct<ts_sec: bigint, file: string, pos: bigint, row: int>"


def decode_raw_changes(df: DataFrame, row_ddl: str, key_ddl: str | None = None, col: str = "value") -> DataFrame:
    """Parse raw change JSON of one table.

    The text holds ``schema_name`` (``server.db.table.Envelope``), ``op``,
    ``key``, ``before``, ``after`` and ``source_offset``.  ``row_ddl`` is the
    schema of the two images, ``key_ddl`` that of the key (none: the table has
    no primary key).
    """
    key = f"`key` struct<{key_ddl}>, " if key_ddl else ""
    schema = (
        f"schema_name string, op string, {key}before struct<{row_ddl}>, "
        f"after struct<{row_ddl}>, source_offset {OFFSET_TYPE}"
    )
    kept = [F.col(quoted(c)) for c in df.columns if c != col]
    return df.select(*kept, F.inline(F.array(F.from_json(F.col(quoted(col)), schema))))
