"""Every tunable number of the surveillance and fund plans, in two frozen records."""

from __future__ import annotations

from dataclasses import dataclass

BASELINES = ("flat", "hybrid", "per_stock")


@dataclass(frozen=True)
class SurveillanceParams:
    baseline: str = "flat"

    # volume spike
    volume_spike_x: float = 5.0
    min_spike_turnover_cr: float = 1.0
    volume_spike_z: float = 3.0
    volume_spike_min_x: float = 2.0

    # price shock
    price_shock_pct: float = 8.0
    sector_calm_pct: float = 2.0
    price_shock_z: float = 3.0
    price_shock_min_pct: float = 4.0
    volatility_floor_pct: float = 1.0

    # pump, and the dump that follows it
    pump_return_5d_pct: float = 15.0
    pump_volume_x: float = 2.0
    pump_low_delivery_ratio: float = 0.7
    dump_lookback_days: int = 10
    dump_return_pct: float = 8.0
    dump_return_3d_pct: float = 15.0

    # delivery anomaly
    delivery_z: float = 2.5
    delivery_high_min_x: float = 2.0
    delivery_low_ratio: float = 0.4
    delivery_low_min_x: float = 3.0

    # circuit streak and gap
    circuit_bands: tuple[float, ...] = (5.0, 10.0, 20.0)
    circuit_tolerance: float = 0.15
    circuit_streak_days: int = 3
    circuit_same_direction: bool = False
    gap_pct: float = 5.0

    # history and score
    min_history_days: int = 25
    illiquid_turnover_cr: float = 1.0
    min_alert_score: float = 30.0
    high_score: float = 70.0
    medium_score: float = 40.0
    news_lookback_days: int = 3

    def __post_init__(self) -> None:
        if self.baseline not in BASELINES:
            raise ValueError(f"baseline must be one of {BASELINES}, got {self.baseline!r}")


@dataclass(frozen=True)
class FundParams:
    risk_free_rate: float = 0.065
    trading_days_per_year: int = 252
    min_nav_count: int = 250


@dataclass(frozen=True)
class QualityParams:
    min_stocks_per_trading_day: int = 1500
    big_move_pct: float = 25.0
    big_move_limit: int = 50
    continuity_limit: float = 0.40
