"""Unpacking the JSON request and response of an inference log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of an inference log, in order.
LOG_SCHEMA = (
    "request_id string, timestamp timestamp, request string, response string, "
    "status_code int, execution_duration_ms long"
)


def unpack_payload(
    df: DataFrame, column: str, schema: str | T.StructType, prefix: str = ""
) -> DataFrame:
    """Parse one JSON object per row to typed columns.

    Text that does not parse gives nulls and sets ``<column>_unparsed``, so bad rows
    stay in the result and can be counted.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    checked = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = df.withColumn("_parsed", F.from_json(column, checked))
    bad = F.col(column).isNotNull() & (
        F.col("_parsed").isNull() | F.col("_parsed._corrupt_record").isNotNull()
    )
    return parsed.select(
        *df.columns,
        *[F.when(~bad, F.col(f"_parsed.{f.name}")).alias(f"{prefix}{f.name}") for f in fields],
        bad.alias(f"{column}_unparsed"),
    )


def unpack_records(
    log: DataFrame,
    feature_schema: str | T.StructType,
    prediction_type: str = "double",
    request_col: str = "request",
    response_col: str = "response",
) -> DataFrame:
    """One row per scored record of ``{"dataframe_records": [{...}]}`` / ``{"predictions": [...]}``.

    ``record`` is the position inside the request and pairs each record with its
    prediction. A request that does not parse keeps one row with null features.
    """
    fields = (
        feature_schema if isinstance(feature_schema, T.StructType) else T.StructType.fromDDL(feature_schema)
    )
    request_type = T.StructType([T.StructField("dataframe_records", T.ArrayType(fields))])
    other = [c for c in log.columns if c not in (request_col, response_col)]
    parsed = log.select(
        *other,
        F.from_json(request_col, request_type)["dataframe_records"].alias("_records"),
        F.from_json(response_col, f"predictions array<{prediction_type}>")["predictions"].alias(
            "_predictions"
        ),
    )
    return (
        parsed.select(*other, "_predictions", F.posexplode_outer("_records").alias("record", "_features"))
        .select(
            *other,
            "record",
            "_features.*",
            F.when(F.col("record").isNotNull(), F.get("_predictions", F.col("record"))).alias("prediction"),
            F.col("record").isNull().alias("request_unparsed"),
        )
    )


def attach_labels(log: DataFrame, labels: DataFrame, key: str, label_col: str, time_col: str | None = None) -> DataFrame:
    """Late ground truth onto logged predictions: every log row stays, the label may be null.

    Labels are reduced to one per key first (the newest by ``time_col``, else the
    greatest), so a repeated label cannot multiply log rows.
    """
    newest = F.max_by(label_col, F.struct(time_col, label_col)) if time_col else F.max(label_col)
    one_per_key = labels.groupBy(key).agg(newest.alias(label_col))
    return log.join(one_per_key, on=key, how="left")
