"""A semi-join with a table of keys that is expected to be small and need not be."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplume.session import as_written


def semi_join(
    big: DataFrame, small: DataFrame, keys: list[str], anti: bool = False, null_keys: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``big`` whose ``keys`` occur in ``small``, or with ``anti`` do not; in ``null_keys`` NULL matches NULL.

    ``small`` is computed once into the shared folder, so that Spark knows its bytes: up to
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and ``big`` does not move, beyond that both sides
    shuffle on the keys and adaptive execution splits a key with a large share of ``big``. Either way the rows are the
    same. Where the years are among the keys, both sides are also bounded by the first and last of ``small``: folders
    of other years are not read, and a broadcast prunes the rest.
    """
    how = "left_anti" if anti else "left_semi"
    small = as_written(small.select(*keys).distinct(), "keys")
    if not anti and "year" in keys and "year" not in null_keys:
        first, last = small.agg(F.min("year"), F.max("year")).first()
        if first is None:
            return big.limit(0)
        big, small = (df.where(F.col("year").between(first, last)) for df in (big, small))
    return big.join(small, _same(big, small, keys, null_keys), how)


def _same(left: DataFrame, right: DataFrame, keys: list[str], null_keys: Sequence[str]) -> Column:
    tests = [left[k].eqNullSafe(right[k]) if k in null_keys else left[k] == right[k] for k in keys]
    return reduce(lambda a, b: a & b, tests)
