import pytest

from tidegauge.operators.windows import granularity_seconds, nested_granularities
from tidegauge.spec import AlertRule, MonitorSpec, alert_rule, environment_config, load_config

SETTINGS = """
environments:
  prod:
    catalog: main
    schema: models
    serving:
      endpoint_name: ignored
    inference_table:
      name: logs
    monitoring:
      output_schema: monitoring
      alerts:
        - metric: prediction_drift
          threshold: 0.05
          severity: critical
          recipients: [a@example.com, b@example.com]
        - metric: data_quality_score
          threshold: 1
"""


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "settings.yml"
    file.write_text(SETTINGS)
    return file


def test_defaults(path):
    config = load_config("prod", path)
    assert config.inference_table.retention_days == 90
    assert config.monitoring.granularities == ("1 day",)
    assert config.monitoring.refresh_schedule == "0 0 * * *"
    first, second = config.monitoring.alerts
    assert first == AlertRule("prediction_drift", 0.05, "critical", "email", ("a@example.com", "b@example.com"))
    assert (second.threshold, second.severity, second.recipients) == (1.0, "warning", ())


def test_missing_file_and_environment(path, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_config("prod", tmp_path / "none.yml")
    with pytest.raises(ValueError):
        load_config("dev", path)


@pytest.mark.parametrize("values", [{"metric": "x"}, {"threshold": 1.0}])
def test_alert_needs_metric_and_threshold(values):
    with pytest.raises(ValueError):
        alert_rule(values)


def test_required_parts():
    with pytest.raises(ValueError):
        environment_config({"catalog": "c", "schema": "s", "monitoring": {"output_schema": "m"}})
    with pytest.raises(ValueError):
        environment_config({"catalog": "c", "schema": "s", "monitoring": {}, "inference_table": {"name": "n"}})


def test_unknown_profile_type_is_an_error():
    with pytest.raises(ValueError, match="Unsupported profile type: Snapshot"):
        MonitorSpec(profile_type="Snapshot")


def test_time_series_monitors_have_no_model_columns():
    spec = MonitorSpec(profile_type="TimeSeries", model_id_col="m", label_col="y", granularities=())
    assert (spec.prediction_col, spec.label_col, spec.model_id_col) == (None, None, None)
    assert spec.granularities == ("1 day",)


def test_granularities():
    assert granularity_seconds("30 minutes") == 1800
    assert nested_granularities(("1 hour", "30 minutes", "1 day")) == "30 minutes"
    assert nested_granularities(("2 hours", "3 hours")) is None
    with pytest.raises(ValueError):
        granularity_seconds("fortnight")


TEMPLATE = """
model: {type: forecasting}
inference_table: {retention_days: 365}
monitoring:
  profile_type: TimeSeries
  granularities: ["1 hour"]
  drift_detection: {enabled: true, baseline: training_data, threshold: 0.1}
  data_quality: {enabled: false, rules: [null_check]}
  alerts: [{metric: data_freshness, threshold: 24}]
features:
  temporal: {timestamp_col: at}
  numerical: [a, b]
"""


def test_templates_fill_the_monitor(tmp_path):
    from tidegauge.spec import load_template

    path = tmp_path / "t.yml"
    path.write_text(TEMPLATE)
    found = load_template(path)
    assert (found.monitor.timestamp_col, found.monitor.numeric_cols, found.monitor.categorical_cols) == ("at", ("a", "b"), ())
    assert (found.drift_threshold, found.quality_rules, found.retention_days) == (0.1, (), 365)
    assert found.alerts[0].threshold == 24.0 and found.monitor.baseline_table == "training_data"
    path.write_text("")
    assert load_template(path).monitor.numeric_cols is None
    with pytest.raises(FileNotFoundError):
        load_template(tmp_path / "nothing.yml")


def test_keys_and_payloads_are_not_profiled(spark):
    from tidegauge.operators.profile import profiled_columns

    log = spark.createDataFrame([], "request_id string, request string, response string, timestamp timestamp, m string, x double, c string, y int")
    assert profiled_columns(log, MonitorSpec(model_id_col="m", exclude_cols=("y",))) == (["x"], ["c"])
