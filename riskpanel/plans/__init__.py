from riskpanel.plans.daily import DailyPaths, run_daily
from riskpanel.plans.results import register_views, result_tables, result_views

__all__ = ["DailyPaths", "register_views", "result_tables", "result_views", "run_daily"]
