"""Read-side removal of superseded snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplume.operators.joins import semi_join
from gridplume.schemas import CHUNK


def latest_snapshot(df: DataFrame, chunk: list[str] = CHUNK, stamp: str = "ingested_at") -> DataFrame:
    """Per chunk, the rows that carry its newest stamp.

    The rule is per snapshot, not per row: a row that the newer snapshot withdrew must vanish. The newest
    stamp is a small aggregate over the chunk columns alone, and the rows are matched to it in place; a
    window over the chunk would move and sort every row, and put a large chunk into one task.
    """
    newest = df.groupBy(*chunk).agg(F.max(stamp).alias(stamp))
    keys = [*chunk, stamp]
    return semi_join(df, newest, keys, null_keys=keys)
