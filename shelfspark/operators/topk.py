"""Top-k over keys: deduplicate by key, then the first k.

One scan and one shuffle of ``(key, value)`` pairs, pre-aggregated in each task
(a hot key crosses the shuffle once per task); the top k of the keys are taken
per partition (``TakeOrderedAndProject``), so no global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k_distinct(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """One row per key: its value is NULL if any row is NULL, else the max.

    Ordered by value descending (NULL first), then key ascending; first k.
    """
    v = F.col(value)
    rep = F.when(F.count_if(v.isNull()) == 0, F.max(v))
    return (df.groupBy(key).agg(rep.alias(value))
            .orderBy(F.col(value).desc_nulls_first(), F.col(key).asc_nulls_first())
            .limit(k))
