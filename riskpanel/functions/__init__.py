from riskpanel.functions.columns import is_excluded, norm, safe_ratio, tenor_bucket, winsorize
from riskpanel.functions.joins import splittable_join

__all__ = ["is_excluded", "norm", "safe_ratio", "splittable_join", "tenor_bucket", "winsorize"]
