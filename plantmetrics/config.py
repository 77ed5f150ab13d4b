"""Thresholds, formats and size limits used by the operators and the layer jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# Raw timestamp texts accepted by the silver layer, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy HH:mm:ss",
)


@dataclass(frozen=True)
class RangeRule:
    """A reading is invalid strictly below ``low`` or strictly above ``high``."""

    column: str
    flag: str
    low: float | None = None
    high: float | None = None


# Physical limits of the sensors.
RANGE_RULES = (
    RangeRule("temperature_c", "is_temp_invalid", -10.0, 120.0),
    RangeRule("vibration_mms", "is_vibration_invalid", 0.0),
    RangeRule("pression_bar", "is_pression_invalid", 0.0),
)

# Measured column -> its forward-filled column.
FILLED_COLUMNS = {
    "temperature_c": "temperature_filled",
    "vibration_mms": "vibration_filled",
    "pression_bar": "pression_filled",
    "courant_a": "courant_filled",
}


# What stands for a missing side of the gold joins.
DAILY_DEFAULTS = {"nb_alarmes": 0, "duree_arret_minutes": 0.0}
WEEKLY_DEFAULTS = {"sum_arret_minutes": 0.0, "sum_produite": 0, "sum_prevue": 1, "sum_rebuts": 0.0}

# Labels of readings and orders.
INVALID, INTERPOLATED, VALID = "INVALID", "INTERPOLATED", "VALID"
RUNNING, LATE, ON_TIME = "EN_COURS", "EN_RETARD", "A_TEMPS"


@dataclass(frozen=True)
class SizeLimits:
    """Measured sizes beyond which an operator switches to its skew-proof form.

    ``max_group_rows``  rows one task may walk in order for a single key
    ``max_slot_rows``   rows of one side that one task may compare with those of the other
    ``chunk_rows``      target rows per chunk once a group is split; as many chunks as that takes
    ``broadcast_rows``  most rows (of a few narrow columns) sent to every executor
    """

    max_group_rows: int = 2_000_000
    max_slot_rows: int = 20_000
    chunk_rows: int = 1_000_000
    broadcast_rows: int = 200_000


@dataclass(frozen=True)
class KpiSettings:
    """Constants of the KPI formulas (fixed values).

    ``sum_scale`` None sums doubles as they are. A number sums them as decimals of that
    scale, which makes totals independent of partitioning and task retries.
    """

    minutes_per_day: float = 1440.0
    minutes_per_week: float = 7 * 24 * 60.0
    units_per_hour: float = 500.0
    mtbf_horizon_hours: float = 30.0 * 24.0
    mtbf_target_hours: float = 200.0
    oee_target_pct: float = 85.0
    overheat_c: float = 95.0
    plot_low_c: float = -10.0
    plot_high_c: float = 130.0
    scatter_points: int = 5000
    scatter_seed: int = 42
    sum_scale: int | None = None


@dataclass(frozen=True)
class Settings:
    """Everything a layer job needs besides its input frames."""

    timestamp_formats: tuple[str, ...] = TIMESTAMP_FORMATS
    timestamp_prefix: bool = False
    range_rules: tuple[RangeRule, ...] = RANGE_RULES
    filled_columns: dict[str, str] = field(default_factory=lambda: dict(FILLED_COLUMNS))
    exclude_invalid_from_fill: bool = False
    dedup_on: str = "raw"
    join_tolerance_s: int = 300
    kpi: KpiSettings = KpiSettings()
    limits: SizeLimits = SizeLimits()


DEFAULTS = Settings()
