"""Document quality by hierarchical empirical Bayes.

A logistic classifier on properties of the text gives each document evidence of its own. A
host's rate of good documents is estimated from the evidence of all its documents and
shrunk to the global rate, a path's to its host's; how strongly is estimated from how much
hosts (paths) differ beyond chance. A document's score moves its own evidence by what its
path says in excess of the global rate.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import join_groups, quoted
from tidegauge.llm.common import crc_fold, stage

#: Bounds on how many documents a prior may weigh.
WEAKEST, STRONGEST = 1.0, 1e6


def properties(text: Column) -> dict[str, Column]:
    """Numbers about a whole text, 0 where there is nothing to divide by; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    n = F.length(text)
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line != "")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0).cast("double")

    letters, signs = F.length(F.regexp_replace(text, r"[^\p{L}]+", "")), F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s.,]+", ""))
    return {
        "log_chars": F.log1p(n).cast("double"),
        "letter_share": share(letters, n),
        "sign_share": share(signs, n),
        "capital_share": share(F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")), n),
        "word_length": share(letters, F.size(words)),
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "distinct_words_scaled": share(F.size(F.array_distinct(words)), F.sqrt(F.size(words))),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "words_per_line": F.log1p(share(F.size(words), F.size(lines))),
    }


def evidence(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``host``, ``path``) with the classifier's probability as ``p`` instead of the text.

    Fitted on all labelled rows outside the held-out fold; where they do not show both
    labels, ``p`` is their share of good documents (0.5 without any).
    """
    measured = docs.select("doc_id", "host", "path", *[c.alias(k) for k, c in properties(F.col("text")).items()])
    measured = stage(measured, "text-properties")
    names = measured.columns[3:]
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("label"))
    learned = measured.join(known, F.col("doc_id") == F.col("_id")).where(crc_fold(F.col("doc_id"), folds) != held_fold)
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    rate = learned.agg(F.count("*").alias("n"), F.avg("label").alias("good")).first()
    if not rate["n"] or rate["good"] in (0.0, 1.0):
        return measured.select("doc_id", "host", "path", F.lit(0.5 if not rate["n"] else rate["good"]).alias("p"))
    model = LogisticRegression(maxIter=50, regParam=1e-4).fit(vectors.transform(learned.select("label", *names)))
    return model.transform(vectors.transform(measured)).select(
        "doc_id", "host", "path", vector_to_array("probability")[1].alias("p")
    )


def prior_weight(groups: DataFrame, centre: Column) -> float:
    """How many documents a prior weighs, from groups with ``n`` and ``good`` (sums) around ``centre``.

    Group rates vary by chance and by what groups really differ in; the moments of the two
    give the size of a beta prior.
    """
    mean = F.col("good") / F.col("n")
    found = groups.agg(
        F.sum(F.col("n") * (mean - centre) ** 2).alias("spread"),
        F.sum(centre * (1 - centre)).alias("chance"),
        F.sum(F.col("n") * centre * (1 - centre)).alias("scale"),
        F.sum("n").alias("n"),
    ).first()
    if not found["n"]:
        return STRONGEST
    real = (found["spread"] - found["chance"]) / found["n"]
    return STRONGEST if real <= 0 else min(STRONGEST, max(WEAKEST, found["scale"] / found["n"] / real - 1))


def site_posteriors(judged: DataFrame) -> tuple[DataFrame, float]:
    """``host``, ``path``, ``host_rate``, ``path_rate``, ``n_host``, ``n_path`` per path of ``judged``, and the global rate."""
    paths = stage(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "path-sums")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    centre = whole["good"] / whole["n"] if whole["n"] else 0.5
    weight = prior_weight(hosts, F.lit(centre))
    rated = hosts.select(
        "host", F.col("n").alias("n_host"), ((F.lit(weight * centre) + F.col("good")) / (F.lit(weight) + F.col("n"))).alias("host_rate")
    )
    nested = join_groups(paths, rated, ["host"])
    weight = prior_weight(nested, F.col("host_rate"))
    return nested.select(
        "host", "path", "host_rate",
        ((F.lit(weight) * F.col("host_rate") + F.col("good")) / (F.lit(weight) + F.col("n"))).alias("path_rate"),
        "n_host", F.col("n").alias("n_path"),
    ), centre


def logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(inside / (1 - inside))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_path(url: Column) -> Column:
    """The first segment of an address's path."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)


def quality_scores(
    docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
    id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_fold: int = 1,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``evidence``, ``host_rate``, ``path_rate``, ``n_host``, ``n_path``, ``score``, ``predicted``.

    ``host`` and ``path`` default to the source and, within it, the language; for crawled
    pages use :func:`url_host` and :func:`url_path`. Null hosts and paths are groups of their
    own. Null texts count as empty, null ids are in no fold (neither held out nor learned
    from), repeated rows count as often as they occur, an empty table gives an empty result.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    chosen = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"), host.alias("host"), path.alias("path"))
    judged = stage(evidence(chosen, labels, folds, held_fold), "evidence")
    sites, centre = site_posteriors(judged)
    excess = logit(F.col("path_rate")) - logit(F.lit(centre))
    score = 1 / (1 + F.exp(-(logit(F.col("p")) + excess)))
    held = F.coalesce(crc_fold(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return join_groups(judged, sites, ["host", "path"]).select(
        "doc_id", held.alias("held_out"), F.col("p").alias("evidence"), "host_rate", "path_rate", "n_host", "n_path", score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
