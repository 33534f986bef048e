"""Model monitoring analytics on Spark: every operator takes and returns a DataFrame."""

from tidegauge.spec import AlertRule, MonitorSpec, load_config

__all__ = ["AlertRule", "MonitorSpec", "load_config"]
