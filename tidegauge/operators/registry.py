"""Runs, model versions and aliases as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where
from tidegauge.functions.scalars import version_number


def qualifying_runs(runs: DataFrame) -> DataFrame:
    """Finished runs that passed the promotion gate."""
    return runs.where((F.col("status") == "FINISHED") & F.col("should_register"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest qualifying run; no row when there is none."""
    return qualifying_runs(runs).orderBy(F.desc("start_time"), "run_id").limit(1)


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The greatest record per key by ``order``, merged map-side, so no key is sorted as a whole."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*")


def latest_runs(runs: DataFrame, experiment: str = "experiment") -> DataFrame:
    return newest_per_key(qualifying_runs(runs), [experiment], ["start_time", "run_id"])


def latest_versions(versions: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """Greatest version per model, compared as a number and given as it is written; null without a numeric one."""
    order = F.struct(version_number(F.col(version)), version)
    numeric = F.when(version_number(F.col(version)).isNotNull(), order)
    return versions.groupBy(name).agg(F.max_by(version, numeric).alias("version"))


def resolve_versions(
    names: DataFrame, versions: DataFrame, aliases: DataFrame, alias: str | None = None
) -> DataFrame:
    """Version per requested model: by alias if one is given, else the greatest; null if there is none."""
    if alias is None:
        return names.join(latest_versions(versions), "name", "left")
    chosen = aliases.where(F.col("alias") == alias).select("name", "version")
    return names.join(chosen, "name", "left")


def model_metadata(versions: DataFrame, wanted: DataFrame) -> DataFrame:
    """The versions named in ``wanted`` (``name``, ``version``)."""
    return versions.join(wanted, ["name", "version"], "left_semi")


def list_versions(versions: DataFrame, name: str, max_results: int = 100) -> DataFrame:
    """Versions of one model, greatest number first."""
    return (
        versions.where(F.col("name") == name)
        .orderBy(F.desc(version_number(F.col("version"))), F.desc("version"))
        .limit(max_results)
    )


def top_versions(versions: DataFrame, max_results: int = 100) -> DataFrame:
    """As ``list_versions`` for all models at once; each task cuts to the top before the shuffle."""
    order = Window.partitionBy("name").orderBy(F.desc(version_number(F.col("version"))), F.desc("version"))
    return (
        versions.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= max_results)
    )


# The checks of a scorecard, in order, and how many of them must pass.
SCORECARD_CHECKS = ("model_loaded", "signature_valid", "inference_passed", "metadata_found")
SCORECARD_MINIMUM = 3


def validation_scorecard(checks: DataFrame, keys: list[str], check: str = "check_name") -> DataFrame:
    """All checks passed: passed; three of four: passed with warnings; fewer: failed.

    ``checks`` has one row per key and check with a boolean ``passed``.
    """
    passed, total = F.col("checks_passed"), len(SCORECARD_CHECKS)
    return (
        checks.where(F.col(check).isin(list(SCORECARD_CHECKS)))
        .groupBy(*keys)
        .agg(count_where(F.col("passed")).cast("int").alias("checks_passed"))
        .select(
            *keys,
            "checks_passed",
            F.lit(total).alias("checks_total"),
            F.when(passed == total, "passed")
            .when(passed >= SCORECARD_MINIMUM, "passed_with_warnings")
            .otherwise("failed")
            .alias("status"),
            (passed >= SCORECARD_MINIMUM).alias("is_valid"),
        )
    )
