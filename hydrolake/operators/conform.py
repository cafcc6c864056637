"""Schema conforming: rename, add missing columns, enforce order and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns present in ``mapping``; others are kept."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def conform_schema(df: DataFrame, schema: StructType | list[tuple[str, str]]) -> DataFrame:
    """Select a fixed column list in order; absent columns become typed NULLs."""
    fields = [(f.name, f.dataType) for f in schema.fields] if isinstance(schema, StructType) else schema
    cols = []
    for name, dtype in fields:
        if name in df.columns:
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


def col_or(df: DataFrame, name: str, default=None):
    """The column if the frame has it, else a literal (schema-level check, no action)."""
    return F.col(name) if name in df.columns else F.lit(default)


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate frames by name; columns missing on one side become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
