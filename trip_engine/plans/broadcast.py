"""Physical-strategy helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

MAX_BROADCAST_BYTES = 256 << 20


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of ``max_bytes`` together (16 bytes a
    column, and the text of values that are no numbers).

    The check reads at most ``max_rows + 1`` rows (a bounded job on the small
    side only), so a lookup that grows unexpectedly is never shipped to every
    executor: callers fall back to a shuffle join instead."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
            for f in df.schema.fields if not isinstance(f.dataType, NumericType)]
    text = reduce(lambda a, b: a + b, wide, F.lit(16 * len(df.columns))).cast("long")
    rows, size = df.select(text.alias("size")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum("size")).first()
    return rows <= max_rows and (size or 0) <= max_bytes
