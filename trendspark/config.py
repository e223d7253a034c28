"""Project parameters and fixed values.

The tunables mirror the project variables of the original model set; every
operator takes them as arguments, these are only the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match.
# ---------------------------------------------------------------------------

# Queue id -> label; any other id (or null) is "Other".
QUEUE_NAMES: dict[int, str] = {
    400: "Normal Draft",
    420: "Ranked Solo/Duo",
    430: "Normal Blind",
    440: "Ranked Flex",
    450: "ARAM",
    700: "Clash",
    1700: "Arena",
}
QUEUE_OTHER = "Other"

# Token the surrogate-key hash uses in place of a null component.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# The nine metrics the trend marts follow, in catalogue order.
TREND_METRICS: tuple[str, ...] = (
    "kda_ratio_perfect_adjusted",
    "cs_per_minute",
    "gold_per_minute",
    "damage_per_minute",
    "vision_score_per_minute",
    "damage_share",
    "gold_share",
    "kill_participation",
    "damage_per_gold",
)

# Metrics offered by the trend view, in display order.
VIEW_METRICS: tuple[str, ...] = (
    "cs_per_minute", "gold_per_minute", "damage_per_minute", "kda_ratio_perfect_adjusted",
    "kill_participation", "damage_share", "vision_score_per_minute",
)
RANGE_OPTIONS: tuple[int, ...] = (10, 20, 50, 100)
MIN_GROUP_GAMES = 5
AXIS_PAD_FRACTION = 0.12

# Participant count columns that default to 0 when the source document lacks them.
PARTICIPANT_COUNT_DEFAULTS: tuple[str, ...] = (
    "kills", "deaths", "assists", "vision_score", "wards_placed",
    "turret_takedowns", "dragon_kills", "baron_kills",
)

# Share-sum tolerance of the team-share check.
SHARE_TOLERANCE = 0.0001


@dataclass(frozen=True)
class TrendConfig:
    """Tunable parameters of the trend build."""

    rolling_window: int = 10
    min_baseline: int = 5
    included_queues: tuple[int, ...] = (400, 420, 440)
    remake_seconds: int = 300
    metrics: tuple[str, ...] = field(default=TREND_METRICS)
    # Rows of one entity handled by one window task. Entities longer than this
    # are split into chunks (see operators.sequence); it bounds task size.
    chunk_rows: int = 1_000_000


DEFAULT = TrendConfig()
