"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertlake.session import keep

#: Bytes above which a dimension is joined by shuffle instead of broadcast.
BROADCAST_MAX_BYTES = 64 << 20
_FIXED_BYTES = 16


def estimated_bytes(df: DataFrame) -> int:
    """Bytes of a table: strings by their length, other columns by a fixed size.

    One partial aggregate per task is shuffled, whatever the size of the table."""
    row = F.lit(_FIXED_BYTES * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            row = row + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0).cast("long"))).first()[0]


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                    materialize: bool = False) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when ``df`` holds at most ``max_bytes``, else ``(df, False)``,
    which leaves the join to the optimizer and AQE.

    ``materialize=True`` keeps ``df`` (for a small table derived from a large
    input, e.g. one row per sender domain): the size check fills it and the
    join reads it instead of aggregating the input twice."""
    if materialize:
        df = keep(df)
    return (F.broadcast(df), True) if estimated_bytes(df) <= max_bytes else (df, False)
