"""Monitor definitions, alert rules and the small YAML reader for them."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

# The profile types and defaults users already have in their settings.
PROFILE_TYPES = ("InferenceLog", "TimeSeries")
PROBLEM_TYPES = ("classification", "regression")
DEFAULT_GRANULARITY = "1 day"
DEFAULT_SCHEDULE = "0 0 * * *"
DEFAULT_RETENTION_DAYS = 90


@dataclass(frozen=True)
class MonitorSpec:
    """What to monitor in a log table and how to cut it into windows and slices."""

    profile_type: str = "InferenceLog"
    timestamp_col: str = "timestamp"
    granularities: tuple[str, ...] = (DEFAULT_GRANULARITY,)
    problem_type: str = "classification"
    prediction_col: str | None = "prediction"
    label_col: str | None = None
    score_col: str | None = None
    model_id_col: str | None = None
    slicing_exprs: tuple[str, ...] = ()
    numeric_cols: tuple[str, ...] | None = None
    categorical_cols: tuple[str, ...] | None = None
    request_id_col: str | None = "request_id"
    payload_cols: tuple[str, ...] = ("request", "response")
    exclude_cols: tuple[str, ...] = ()
    baseline_table: str | None = None
    output_schema: str = "monitoring"

    def __post_init__(self) -> None:
        if self.profile_type not in PROFILE_TYPES:
            raise ValueError(f"Unsupported profile type: {self.profile_type}")
        if self.problem_type not in PROBLEM_TYPES:
            raise ValueError(f"Unsupported problem type: {self.problem_type}")
        for name in ("granularities", "slicing_exprs", "numeric_cols", "categorical_cols", "payload_cols", "exclude_cols"):
            value = getattr(self, name)
            if value is not None:
                object.__setattr__(self, name, tuple(value))
        if not self.granularities:
            object.__setattr__(self, "granularities", (DEFAULT_GRANULARITY,))
        if self.profile_type == "TimeSeries":
            for name in ("prediction_col", "label_col", "score_col", "model_id_col"):
                object.__setattr__(self, name, None)

    @property
    def unprofiled(self) -> tuple[str, ...]:
        """Columns that say which row it is or hold raw payloads: no defaults of a profile or of drift."""
        named = (self.timestamp_col, self.model_id_col, self.request_id_col, *self.payload_cols, *self.exclude_cols)
        return tuple(c for c in named if c)


@dataclass(frozen=True)
class AlertRule:
    metric: str
    threshold: float
    severity: str = "warning"
    notification_type: str = "email"
    recipients: tuple[str, ...] = ()


@dataclass(frozen=True)
class InferenceTableConfig:
    name: str
    retention_days: int = DEFAULT_RETENTION_DAYS


@dataclass(frozen=True)
class MonitoringSettings:
    output_schema: str
    granularities: tuple[str, ...] = (DEFAULT_GRANULARITY,)
    refresh_schedule: str = DEFAULT_SCHEDULE
    alerts: tuple[AlertRule, ...] = field(default_factory=tuple)


@dataclass(frozen=True)
class EnvironmentConfig:
    catalog: str
    schema: str
    inference_table: InferenceTableConfig
    monitoring: MonitoringSettings


def _build(cls: type, values: dict[str, Any], where: str) -> Any:
    """Fill a dataclass from a mapping: unknown keys are ignored, missing ones are errors."""
    known = {f.name for f in fields(cls)}
    try:
        return cls(**{k: v for k, v in values.items() if k in known})
    except TypeError as error:
        raise ValueError(f"{where}: {error}") from None


def alert_rule(values: dict[str, Any]) -> AlertRule:
    rule = _build(AlertRule, {**values, "recipients": tuple(values.get("recipients") or ())}, "alert")
    return AlertRule(rule.metric, float(rule.threshold), rule.severity, rule.notification_type, rule.recipients)


def environment_config(values: dict[str, Any]) -> EnvironmentConfig:
    for part in ("inference_table", "monitoring"):
        if part not in values:
            raise ValueError(f"environment: missing '{part}'")
    monitoring = dict(values["monitoring"])
    monitoring["alerts"] = tuple(alert_rule(a) for a in monitoring.get("alerts") or ())
    if "granularities" in monitoring:
        monitoring["granularities"] = tuple(monitoring["granularities"])
    return _build(
        EnvironmentConfig,
        {
            **values,
            "inference_table": _build(InferenceTableConfig, values["inference_table"], "inference_table"),
            "monitoring": _build(MonitoringSettings, monitoring, "monitoring"),
        },
        "environment",
    )


def load_config(environment: str, config_path: str | Path) -> EnvironmentConfig:
    """Read one environment of a YAML settings file."""
    path = Path(config_path)
    if not path.exists():
        raise FileNotFoundError(f"Configuration file not found: {path}")
    import yaml

    environments = (yaml.safe_load(path.read_text()) or {}).get("environments", {})
    if environment not in environments:
        raise ValueError(f"Environment '{environment}' not found in configuration")
    return environment_config(environments[environment])


@dataclass(frozen=True)
class ModelTemplate:
    """A model's monitoring template: what to monitor, with which rules and alerts."""

    monitor: MonitorSpec
    drift_threshold: float | None
    quality_rules: tuple[str, ...]
    alerts: tuple[AlertRule, ...]
    retention_days: int = DEFAULT_RETENTION_DAYS


def model_template(values: dict[str, Any]) -> ModelTemplate:
    """A template as read from YAML; parts that are switched off or absent are left out.

    Listed features are the profiled columns, the target is the label; a temporal block
    names the timestamp. Without any listed feature the defaults of the log's schema hold.
    """
    monitoring, features = values.get("monitoring") or {}, values.get("features") or {}
    model = values.get("model") or {}

    def enabled(part: str) -> dict[str, Any]:
        block = monitoring.get(part) or {}
        return block if block.get("enabled", True) else {}

    kind = str(model.get("type", "classification"))
    profile_type = monitoring.get("profile_type", "InferenceLog")
    temporal = features.get("temporal") or {}
    listed = bool(features.get("numerical") or features.get("categorical"))
    drift, quality = enabled("drift_detection"), enabled("data_quality")
    monitor = MonitorSpec(
        profile_type=profile_type,
        timestamp_col=temporal.get("timestamp_col", "timestamp"),
        granularities=tuple(monitoring.get("granularities") or (DEFAULT_GRANULARITY,)),
        problem_type=kind if kind in PROBLEM_TYPES else "regression",
        label_col=features.get("target"),
        numeric_cols=tuple(features.get("numerical") or ()) if listed else None,
        categorical_cols=tuple(features.get("categorical") or ()) if listed else None,
        baseline_table=drift.get("baseline"),
        output_schema=monitoring.get("output_schema", "monitoring"),
    )
    table = values.get("inference_table") or {}
    return ModelTemplate(
        monitor,
        float(drift["threshold"]) if "threshold" in drift else None,
        tuple(quality.get("rules") or ()),
        tuple(alert_rule(a) for a in monitoring.get("alerts") or ()),
        int(table.get("retention_days", DEFAULT_RETENTION_DAYS)),
    )


def load_template(path: str | Path) -> ModelTemplate:
    """Read a model template file."""
    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"Template file not found: {path}")
    import yaml

    return model_template(yaml.safe_load(path.read_text()) or {})


def column_roles(
    schema, exclude: tuple[str, ...] = ()
) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Default roles from a schema: numeric types are numeric, strings and booleans categorical."""
    from pyspark.sql import types as T

    numeric = tuple(
        f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    )
    categorical = tuple(
        f.name
        for f in schema
        if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude
    )
    return numeric, categorical
