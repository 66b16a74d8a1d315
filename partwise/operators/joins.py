"""Join helpers: size-checked broadcast and balanced unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (file bytes scaled by the projection)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - plan without statistics
        return None


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes, in whatever unit it was set; 0 if it is off."""
    return max(0, int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is below ``limit``.

    Beyond the limit the frame is left alone: the planner shuffles both sides
    (sort-merge join), adaptive execution may still switch to a broadcast
    when the measured shuffle output is small, and its skew-join rule splits a
    hot key on the streamed side.
    """
    limit = broadcast_limit(df) if limit is None else limit
    size = estimated_bytes(df)
    if limit > 0 and size is not None and size <= limit:
        return F.broadcast(df)
    return df


def union_all(frames: list[DataFrame]) -> DataFrame:
    """By-name union of many frames as a balanced tree.

    Each union is analysed when it is built; a left-deep chain re-analyses the
    growing plan at every step, a balanced tree keeps that to log depth.
    """
    if not frames:
        raise ValueError("nothing to union")
    level = list(frames)
    while len(level) > 1:
        level = [
            level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)
        ]
    return level[0]
