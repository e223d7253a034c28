"""Join helpers: size-checked broadcast and null-safe equi joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.session import shuffle_partitions

TASK_BYTES = 4 << 20       # stored bytes of input that one task of a wide step takes
_UNKNOWN = 1 << 50         # estimates above this are Spark's defaults, not sizes


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` (from file sizes / statistics, no job run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - estimate unavailable
        return 1 << 62


def parts_for(*frames: DataFrame) -> int:
    """Partitions in which a step over these stored frames holds ``TASK_BYTES`` a task; 0 where no
    size is known, as with joins, whose estimates are products."""
    size = sum(estimated_bytes(df) for df in frames)
    scans = all(df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1 for df in frames)
    return -(-size // TASK_BYTES) if scans and size <= _UNKNOWN else 0


def spread(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over ``parts`` partitions where the session's number is too small
    for its size, else as it is; windows, joins and aggregates over the keys keep the partitions."""
    return df.repartition(parts, *keys) if parts > shuffle_partitions(df.sparkSession) else df


def spread_by_range(df: DataFrame, parts: int, key: str) -> DataFrame:
    """``df`` dealt by ranges of ``key``, one key in one partition, over ``parts`` partitions or the
    session's number. Windows over the key (and more) keep them, so their rows can be written
    laid out by it as they are."""
    return df.repartitionByRange(max(parts, shuffle_partitions(df.sparkSession)), key)


def session_limit(df: DataFrame) -> int:
    """The session's own broadcast threshold in bytes (negative: never broadcast)."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def broadcast_if_small(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the estimated size is under the session's threshold
    (or ``limit_bytes``).

    Otherwise the frame is returned unchanged and the planner keeps a shuffle join
    (sort-merge, with AQE able to split skewed partitions).
    """
    limit = session_limit(df) if limit_bytes is None else limit_bytes
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def null_free_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key columns only, rows with a null key dropped (they can never match)."""
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.select(*keys).where(cond)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys match each other (``<=>``); keys appear once."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    joined = left.join(r, cond, how)
    return joined.drop(*[f"__r_{k}" for k in keys])
