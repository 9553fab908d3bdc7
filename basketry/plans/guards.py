"""Size-checked broadcast.

A derived side is stored once in the shared checkpoint folder, measured there
(rows and bytes) and broadcast only within both bounds; beyond them the plain
frame is returned and Spark shuffles both sides (adaptive execution may still
switch to a broadcast from measured sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.plans.lineage import materialize

# Largest side we broadcast after an explicit check.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 2**20


def measured_size(df: DataFrame) -> tuple[int, int]:
    """``(rows, bytes)``: strings and binaries by their length, arrays by 8 bytes an entry, other columns as 8 bytes."""
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        long = isinstance(field.dataType, (T.StringType, T.BinaryType))
        if isinstance(field.dataType, T.ArrayType):
            width = width + 8 * F.greatest(F.coalesce(F.size(field.name), F.lit(0)), F.lit(1))
        else:
            width = width + (F.coalesce(F.octet_length(field.name), F.lit(0)) if long else F.lit(8))
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return int(row[0]), int(row[1])


def broadcast_checked(stored: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(frame, within)``: a stored frame with a broadcast hint if it is within both bounds."""
    rows, size = measured_size(stored)
    within = rows <= max_rows and size <= max_bytes
    return (F.broadcast(stored) if within else stored), within


def broadcast_stored(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                     max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Like ``broadcast_checked`` for a derived frame that is expensive to
    recompute (an aggregate over all basket items): it is written once, measured
    there and broadcast from the stored copy, so the aggregate runs once."""
    return broadcast_checked(materialize(df), max_rows, max_bytes)
