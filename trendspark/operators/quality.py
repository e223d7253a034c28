"""Data-quality assertions. Each returns the DataFrame of failing rows (empty = pass).

``summary`` turns any of them into a one-row (rows_checked, rows_failing) report.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.config import SHARE_TOLERANCE


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once (nulls ignored)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence,
                    where: Column | None = None) -> DataFrame:
    scope = df if where is None else df.where(where)
    return scope.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                   where: Column | None = None) -> DataFrame:
    """Rows outside [min, max] (inclusive). Nulls pass, as in SQL."""
    scope = df if where is None else df.where(where)
    conds = []
    if min_value is not None:
        conds.append(F.col(column) < F.lit(min_value))
    if max_value is not None:
        conds.append(F.col(column) > F.lit(max_value))
    if not conds:
        return scope.limit(0)
    return scope.where(_any(conds))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join)."""
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def group_size(df: DataFrame, key: Sequence[str] | str, expected: int = 10,
               count_name: str = "participant_count") -> DataFrame:
    """Groups whose row count differs from ``expected``."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) != expected))


def negative_condition(columns: Sequence[str]) -> Column:
    return _any([F.col(c) < 0 for c in columns])


def no_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(negative_condition(columns))


def shares_sum_to_one(df: DataFrame, share: str = "damage_share", group: Sequence[str] = ("match_id", "team_id"),
                      group_rows: int = 5, tolerance: float = SHARE_TOLERANCE) -> DataFrame:
    """Full groups whose non-null shares do not sum to 1 within tolerance."""
    sums = (df.where(F.col(share).isNotNull()).groupBy(*group)
            .agg(F.sum(share).alias(f"total_{share}"), F.count(F.lit(1)).alias("participants")))
    return sums.where((F.col("participants") == group_rows)
                      & (F.abs(F.col(f"total_{share}") - 1.0) > tolerance))


def _counts_current(seq: str = "match_sequence_number") -> Column:
    return F.col("baseline_match_count") != F.col(seq) - 1


def _first_with_baseline(seq: str = "match_sequence_number") -> Column:
    return (F.col(seq) == 1) & (F.col("baseline_mean").isNotNull() | F.col("z_score").isNotNull()
                                | F.col("delta_from_baseline").isNotNull())


def _window_outside(seq: str = "champion_match_sequence_number", group_count: str = "player_champion_match_count") -> Column:
    return (F.col("matches_in_window") > F.col(seq)) | (F.col("matches_in_window") > F.col(group_count))


# failing conditions of the checks that look at one row, by name
ROW_CONDITIONS = {"baseline_excludes_current": _counts_current, "first_has_no_baseline": _first_with_baseline,
                  "window_within_group": _window_outside}


def baseline_excludes_current(deltas: DataFrame, seq: str = "match_sequence_number") -> DataFrame:
    return deltas.where(_counts_current(seq))


def first_has_no_baseline(deltas: DataFrame, seq: str = "match_sequence_number") -> DataFrame:
    return deltas.where(_first_with_baseline(seq))


def sequences_gapless(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    bounds = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_present"),
                                   F.max(seq).alias("highest"), F.min(seq).alias("lowest"))
    return bounds.where((F.col("lowest") != 1) | (F.col("highest") != F.col("rows_present")))


def window_within_group(df: DataFrame, seq: str = "champion_match_sequence_number",
                        group_count: str = "player_champion_match_count") -> DataFrame:
    return df.where(_window_outside(seq, group_count))


def covered_by(subsets: Sequence[DataFrame], fact: DataFrame, key: str) -> DataFrame:
    """Keys present in any of ``subsets`` (UNION distinct) but missing from ``fact``."""
    keys = reduce(lambda a, b: a.union(b), [s.select(key) for s in subsets]).distinct()
    return keys.join(fact.select(key).distinct(), key, "left_anti")


def summary(checked: DataFrame, failing: DataFrame) -> DataFrame:
    """One row: rows_checked, rows_failing (one aggregate over a tagged union)."""
    tagged = (checked.select(F.lit(1).alias("_c"), F.lit(0).alias("_f"))
              .unionByName(failing.select(F.lit(0).alias("_c"), F.lit(1).alias("_f"))))
    return tagged.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("rows_checked"),
                      F.coalesce(F.sum("_f"), F.lit(0)).cast("long").alias("rows_failing"))
