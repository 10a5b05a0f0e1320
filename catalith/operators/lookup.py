"""Join of many rows with a lookup table whose hot keys are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows, key length and bytes of the broadcast part; a wide table gets fewer rows.
HOT_ROWS = 10_000
HOT_KEY_LENGTH = 256
HOT_BYTES = 16 << 20
# Bytes of a number in a row.
_CELL_BYTES = 16
# Rows of one key that a single task joins without harm.
TASK_ROWS = 1_000_000


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    weight: str,
    how: str = "inner",
    most_rows: int | None = None,
) -> DataFrame:
    """``rows`` joined with ``table`` on the text column ``key``.

    The keys with the largest ``weight`` (how many rows hold them) are
    broadcast, at most ``HOT_ROWS`` rows or ``HOT_BYTES``, so their rows are not
    shuffled. Any other key then has at most as many rows as each of these, and is
    joined by a shuffle. ``table`` has numbers besides the key, and ``weight`` must
    not be null in it. If no key can have more than ``TASK_ROWS``
    rows, as ``most_rows`` tells, one plain join does.
    """
    if most_rows is not None and most_rows <= TASK_ROWS:
        return rows.join(table, key, how)
    short = table.where(F.length(key) <= HOT_KEY_LENGTH)
    row_bytes = HOT_KEY_LENGTH + _CELL_BYTES * len(table.columns)
    few = max(1, min(HOT_ROWS, HOT_BYTES // row_bytes))
    hot = short.orderBy(F.desc(weight), F.asc(key)).limit(few)
    marked = rows.join(F.broadcast(hot), key, "left")
    rest = marked.where(F.col(weight).isNull()).select(*rows.columns).join(table, key, how)
    return marked.where(F.col(weight).isNotNull()).unionByName(rest)
