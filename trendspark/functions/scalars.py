"""Scalar Column functions (all JVM-side, codegen friendly).

Each takes and returns ``Column`` objects so they compose inside ``select`` /
``withColumns`` without leaving whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendspark.config import QUEUE_NAMES, QUEUE_OTHER, SURROGATE_NULL_TOKEN, SURROGATE_SEPARATOR


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division that is null when the denominator is null or zero."""
    d = col(denominator)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(
        col(numerator).cast("double") / d.cast("double"))


def per_minute(value: str | Column, minutes: str | Column) -> Column:
    """Rate per minute; null when minutes is null or under one."""
    m = col(minutes)
    return F.when(m.isNull() | (m < 1), F.lit(None).cast("double")).otherwise(
        col(value).cast("double") / m.cast("double"))


def patch_from_version(version: str | Column) -> Column:
    """First two dot-separated parts: '14.18.615.9137' -> '14.18'; '14' -> '14.'."""
    v = col(version)
    dot = F.lit(".")
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.split_part(v, dot, F.lit(1)), dot, F.split_part(v, dot, F.lit(2))))


def queue_name(queue_id: str | Column) -> Column:
    """Label of a queue id; unknown or null ids are 'Other'."""
    q = col(queue_id).cast("int")
    expr = None
    for qid, label in QUEUE_NAMES.items():
        expr = (F.when(q == qid, label) if expr is None else expr.when(q == qid, label))
    return expr.otherwise(QUEUE_OTHER)


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the '-'-joined text of the columns, null parts replaced by a token."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def epoch_ms_to_timestamp(ms: str | Column) -> Column:
    """Epoch milliseconds to timestamp; sub-second part kept."""
    return F.timestamp_millis(col(ms).cast("long"))


def seconds_to_minutes(seconds: str | Column) -> Column:
    return col(seconds).cast("double") / F.lit(60.0)


def kda_strict(kills: str | Column, deaths: str | Column, assists: str | Column) -> Column:
    """(kills + assists) / deaths, null when deaths is 0 or null."""
    return safe_divide(col(kills) + col(assists), F.nullif(col(deaths), F.lit(0)))


def kda_adjusted(kills: str | Column, deaths: str | Column, assists: str | Column) -> Column:
    """(kills + assists) / max(deaths, 1); a deathless game counts one death."""
    return (col(kills) + col(assists)).cast("double") / F.greatest(col(deaths), F.lit(1)).cast("double")


def win_label(is_win: str | Column) -> Column:
    """'win' when true, 'loss' otherwise (null counts as a loss)."""
    return F.when(col(is_win), F.lit("win")).otherwise(F.lit("loss"))


def split_identifier(text: str | Column) -> tuple[Column, Column, Column]:
    """Split 'name#tag' at the first '#', trimming all white space from both parts.

    Returns (name, tag, is_valid); invalid when '#' is missing or either part is empty.
    """
    t = col(text)
    has_hash = F.instr(t, "#") > 0
    edges = r"(?U)^\s+|\s+$"
    name = F.regexp_replace(F.substring_index(t, "#", 1), edges, "")
    tag = F.regexp_replace(F.regexp_extract(t, r"(?s)^[^#]*#(.*)$", 1), edges, "")
    valid = F.coalesce(has_hash & (F.length(name) > 0) & (F.length(tag) > 0), F.lit(False))
    return (F.when(valid, name), F.when(valid, tag), valid)
