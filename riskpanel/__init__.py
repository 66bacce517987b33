"""Portfolio risk metrics over large return panels, as Spark DataFrame operators."""

from riskpanel.config import RiskConfig

__all__ = ["RiskConfig"]
