"""Model parameters of one daily run."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime

# Fixed values of the model.
EPS = 1e-12
VAR_ALPHA = 1.6449
ANNUAL_DAYS = 252.0
HISTORY_DAYS = 252
BOOTSTRAP_DAYS = 30

# Upper limit of the days of a history. Every operator that takes days checks it; more days are an
# error. It proves that the days may travel as values and as a broadcast table.
MAX_HISTORY_DAYS = 1008

_CHOICES = {
    "benchmark_mode": ("ID", "AVG"),
    "classes": ("code", "spec"),
    "comparable_scope": ("portfolio", "market"),
    "beta_weighting": ("sum", "normalized"),
    "beta_nulls": ("pairwise", "separate"),
}


def check_days(n: int) -> int:
    if not 1 <= n <= MAX_HISTORY_DAYS:
        raise ValueError(f"history_days outside [1, {MAX_HISTORY_DAYS}]: {n}")
    return n


def as_date(value: date | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(value, "%Y-%m-%d").date()


@dataclass(frozen=True)
class RiskConfig:
    """Validated on creation.

    classes           "code": MON, rate swaps and shares; "spec": every documented class
    comparable_scope  "portfolio": the managed portfolio's own returns; "market": all managers
    benchmark_mode    "ID": one manager; "AVG": zero-filled mean of all other managers
    beta_weighting    "sum": unweighted daily sums; "normalized": cutoff weights per side
    beta_nulls        "pairwise": a date with a missing side counts for neither; "separate":
                      each side keeps its own dates in its mean and variance
    use_imputed       fall back to the mean imputed return where a group has no weight
    derivatives       False: the portfolio side leaves out swaps, the benchmark keeps them
    """

    cutoff: date
    portfolio_id: str = "PORTFOLIO"
    benchmark_id: str = "BENCHMARK"
    benchmark_mode: str = "ID"
    ret_cap: float = 0.20
    window_days: int = 120
    history_days: int = HISTORY_DAYS
    classes: str = "code"
    comparable_scope: str = "portfolio"
    beta_weighting: str = "sum"
    beta_nulls: str = "pairwise"
    use_imputed: bool = False
    derivatives: bool = True

    def __post_init__(self) -> None:
        object.__setattr__(self, "cutoff", as_date(self.cutoff))
        for name in ("portfolio_id", "benchmark_id", "benchmark_mode"):
            object.__setattr__(self, name, getattr(self, name).strip().upper())
        if self.portfolio_id == self.benchmark_id:
            raise ValueError("portfolio_id and benchmark_id must differ")
        if not 0.01 <= self.ret_cap <= 1.0:
            raise ValueError(f"ret_cap outside [0.01, 1.0]: {self.ret_cap}")
        if not 20 <= self.window_days <= 504:
            raise ValueError(f"window_days outside [20, 504]: {self.window_days}")
        check_days(self.history_days)
        for name, allowed in _CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}: {getattr(self, name)}")

    def with_(self, **changes) -> RiskConfig:
        return replace(self, **changes)
