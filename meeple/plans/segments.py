"""Player segmentation: inactive rules, K-means on Spark ML, cluster labelling.

Flow of the training job (Q6): demographics -> account age -> split off inactive users ->
assemble 4 features -> standardise -> K-means -> label clusters Whale / Hardcore /
Casual -> union with the Inactive users. Everything runs on executors; the only values
that reach the driver are model parameters (k centroids, 4 means and deviations).
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meeple.functions.exprs import half_up_mean, round_decimal, scaled_units
from meeple.operators import tables
from meeple.sources.readers import as_date

FEATURES = ["total_sessions", "avg_session_duration", "total_spent", "num_purchases"]
SEGMENT_COLUMNS = [
    "user_id", "gender", "age_bracket", "country",
    "total_sessions", "avg_session_duration", "total_spent", "num_purchases", "user_segment",
]

# Fixed values of the reference: segment labels and rule thresholds.
WHALE, HARDCORE, CASUAL, INACTIVE = "Whale", "Hardcore", "Casual", "Inactive"
RATE_RULE_MIN_RATE = 0.25  # sessions per day of account age
TRAIN_MIN_MINUTES = 15.0  # mean session minutes, training job
SCORE_MIN_MINUTES = 5.0  # mean session minutes, scoring job
SIMPLE_RULE_MIN_SESSIONS = 3
DRAFT_RULE_MIN_SESSIONS = 4
DRAFT_RULE_MIN_MINUTES = 10.0
DEFAULT_K = 3
DEFAULT_SEED = 42
# Partitions in which the model sees the users. K-means draws its starting points by partition
# and row, so this is a model parameter: with it fixed, the segments do not depend on the
# cluster's settings.
DEFAULT_PLACEMENT = 8


# ---------------------------------------------------------------------------- rules (M1)


def with_account_age(demographics: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Add ``user_age_days`` = days from registration to ``as_of`` (an explicit date, so
    a rerun gives the same answer on any day)."""
    return demographics.withColumn(
        "user_age_days", F.datediff(F.lit(as_date(as_of)), F.col("registration_date"))
    )


def inactive_condition(
    rule: str = "rate",
    min_rate: float = RATE_RULE_MIN_RATE,
    min_minutes: float = TRAIN_MIN_MINUTES,
) -> Column:
    """The predicate of an inactive user.

    * ``rate``: no spend and (sessions per day of account age below ``min_rate`` or mean
      session below ``min_minutes``). A zero account age gives a NULL rate, and the
      user counts as inactive only through the duration test.
    * ``simple``: fewer than 3 sessions and no spend.
    * ``draft``: (fewer than 4 sessions or mean session below 10 minutes) and no spend.
    """
    spent_nothing = F.col("total_spent") == 0
    if rule == "rate":
        rate = F.try_divide(F.col("total_sessions"), F.col("user_age_days"))
        return spent_nothing & ((rate < min_rate) | (F.col("avg_session_duration") < min_minutes))
    if rule == "simple":
        return (F.col("total_sessions") < SIMPLE_RULE_MIN_SESSIONS) & spent_nothing
    if rule == "draft":
        short = (F.col("total_sessions") < DRAFT_RULE_MIN_SESSIONS) | (
            F.col("avg_session_duration") < DRAFT_RULE_MIN_MINUTES
        )
        return short & spent_nothing
    raise ValueError(f"unknown rule {rule!r}")


def split_inactive(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(active, inactive): inactive rows match ``condition``; active = df EXCEPT DISTINCT
    inactive, so exact duplicate active rows collapse (as in the reference).

    Catalyst rewrites this EXCEPT over a filter of the same input into one filter plus a
    distinct aggregate (no join), combined map-side before the shuffle.
    """
    inactive = df.filter(condition)
    return df.subtract(inactive), inactive


def tag(df: DataFrame, label: str, column: str = "user_segment") -> DataFrame:
    return df.withColumn(column, F.lit(label))


# ------------------------------------------------------------------- cluster labels (M5/M6)


def cluster_profile(clustered: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Per cluster: mean spend and mean session duration (exact: both inputs have two
    decimals, so the means are computed from integer hundredths)."""
    n = F.count(F.lit(1))
    return clustered.groupBy(cluster_col).agg(
        (F.sum(scaled_units("total_spent", 2)) / (n * 100.0)).alias("avg_spent"),
        (F.sum(scaled_units("avg_session_duration", 2)) / (n * 100.0)).alias("avg_duration"),
    )


def cluster_label_map(profile: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """(cluster, user_segment): the highest mean spend is Whale, the highest mean duration
    of the others Hardcore, the rest Casual; ties go to the smaller cluster id.

    ``profile`` has one row per cluster (k rows), so the global windows here sort k rows.
    """
    by_spend = Window.orderBy(F.col("avg_spent").desc(), F.col(cluster_col).asc())
    ranked = profile.withColumn("_spend_rank", F.row_number().over(by_spend))
    by_duration = Window.orderBy(F.col("avg_duration").desc(), F.col(cluster_col).asc())
    rest = (
        ranked.filter(F.col("_spend_rank") > 1)
        .withColumn("_duration_rank", F.row_number().over(by_duration))
        .select(cluster_col, "_duration_rank")
    )
    labelled = ranked.join(rest, cluster_col, "left")
    segment = (
        F.when(F.col("_spend_rank") == 1, WHALE)
        .when(F.col("_duration_rank") == 1, HARDCORE)
        .otherwise(CASUAL)
    )
    return labelled.select(cluster_col, "avg_spent", "avg_duration", segment.alias("user_segment"))


def label_clusters(clustered: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Attach ``user_segment`` to every clustered row.

    The label map has at most k rows (k is a model parameter), so it is broadcast: the
    clustered rows are not shuffled.
    """
    labels = cluster_label_map(cluster_profile(clustered, cluster_col), cluster_col)
    return clustered.join(F.broadcast(labels.select(cluster_col, "user_segment")), cluster_col, "left")


# ---------------------------------------------------------------- profiles


def segment_profile(segments: DataFrame) -> DataFrame:
    """Per segment: mean sessions, duration, spend, purchases (2 decimals) and user count."""
    n = F.count("user_id")
    return segments.groupBy("user_segment").agg(
        half_up_mean(F.sum("total_sessions"), n, 0).alias("avg_sessions"),
        half_up_mean(F.sum(scaled_units("avg_session_duration", 2)), n, 2).alias("avg_duration"),
        half_up_mean(F.sum(scaled_units("total_spent", 2)), n, 2).alias("avg_spent"),
        half_up_mean(F.sum("num_purchases"), n, 0).alias("avg_purchases"),
        n.alias("count"),
    ).orderBy("user_segment")


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("user_segment").agg(F.count(F.lit(1)).alias("count"))


# --------------------------------------------------------------- Spark ML


def assembler() -> VectorAssembler:
    """M2: the 4 activity features as one vector (inputs are never NULL: the demographics
    job coalesces them)."""
    return VectorAssembler(inputCols=FEATURES, outputCol="features_vec")


def scaler() -> StandardScaler:
    """M3: zero mean, unit (sample) standard deviation."""
    return StandardScaler(
        inputCol="features_vec", outputCol="scaled_features", withMean=True, withStd=True
    )


def kmeans(k: int = DEFAULT_K, seed: int = DEFAULT_SEED) -> KMeans:
    """M4: K-means (k-means|| init, 20 iterations, tol 1e-4) on the scaled features."""
    return KMeans(featuresCol="scaled_features", predictionCol="cluster", k=k, seed=seed)


def segmentation_pipeline(k: int = DEFAULT_K, seed: int = DEFAULT_SEED) -> Pipeline:
    return Pipeline(stages=[assembler(), scaler(), kmeans(k, seed)])


def feature_zscores(active: DataFrame) -> DataFrame:
    """Standardised features per user (StandardScaler output as columns, 6 decimals)."""
    model = Pipeline(stages=[assembler(), scaler()]).fit(active)
    z = vector_to_array(F.col("scaled_features"))
    return model.transform(active).select(
        "user_id",
        *[round_decimal(z[i], 6).cast("double").alias(f"z_{c}") for i, c in enumerate(FEATURES)],
    )


def _placed(active: DataFrame, placement: int) -> DataFrame:
    """The rows in a fixed number of partitions and a fixed order inside them (an explicit count
    is never coalesced)."""
    first = [c for c in ("user_id",) if c in active.columns]
    return active.repartition(placement, "user_id").sortWithinPartitions(*first, *[c for c in active.columns if c not in first])


def _split_stable(df: DataFrame, condition: Column, placement: int) -> tuple[DataFrame, DataFrame]:
    """(active, inactive), both stored: the model passes and the labelling read the active users
    many times, and neither the joins behind the per-user table nor the EXCEPT run again."""
    active, inactive = split_inactive(tables.stage(df), condition)
    return _placed(tables.stage(active), placement), inactive


def _clusters(active: DataFrame, k: int) -> int:
    """``k``, or fewer where there are fewer different users than that (K-means needs as many
    points as clusters)."""
    different = active.select(*FEATURES).distinct().limit(k).count()
    if different < 2:
        raise ValueError("segmentation needs at least two different active users")
    return min(k, different)


def _finish(clustered: DataFrame, inactive: DataFrame) -> DataFrame:
    active = label_clusters(clustered).drop("features_vec", "scaled_features", "cluster")
    return active.unionByName(tag(inactive, INACTIVE))


def train_segments(
    demographics: DataFrame,
    as_of: dt.date | str,
    k: int = DEFAULT_K,
    seed: int = DEFAULT_SEED,
    min_rate: float = RATE_RULE_MIN_RATE,
    min_minutes: float = TRAIN_MIN_MINUTES,
    rule: str = "rate",
    placement: int = DEFAULT_PLACEMENT,
) -> tuple[DataFrame, PipelineModel]:
    """Q6/M7: split, fit assembler + scaler + K-means on the active users, label, union.

    Returns the segmented users (demographics columns, ``user_age_days``,
    ``user_segment``) and the fitted three-stage pipeline. ``rule`` is any inactive rule
    (``draft`` is the older trainer's). ``placement``: see ``DEFAULT_PLACEMENT``.
    """
    df = with_account_age(demographics, as_of)
    active, inactive = _split_stable(df, inactive_condition(rule, min_rate, min_minutes), placement)
    model = segmentation_pipeline(_clusters(active, k), seed).fit(active)
    return _finish(model.transform(active), inactive), model


def score_segments(
    demographics: DataFrame,
    as_of: dt.date | str,
    model: PipelineModel,
    refit_scaler: bool = False,
    min_rate: float = RATE_RULE_MIN_RATE,
    min_minutes: float = SCORE_MIN_MINUTES,
    placement: int = DEFAULT_PLACEMENT,
) -> DataFrame:
    """Q7/M8: segment users with a saved pipeline.

    ``refit_scaler=True`` reproduces the reference: the scaler is fitted again on the day's
    active users and the saved centroids are applied to that scaling.
    """
    df = with_account_age(demographics, as_of)
    active, inactive = _split_stable(df, inactive_condition("rate", min_rate, min_minutes), placement)
    if refit_scaler:
        centroids = [s for s in model.stages if isinstance(s, KMeansModel)][-1]
        scaled = Pipeline(stages=[assembler(), scaler()]).fit(active).transform(active)
        clustered = centroids.transform(scaled)
    else:
        clustered = model.transform(active)
    return _finish(clustered, inactive)


def simple_segments(
    gold_demographics: DataFrame, k: int = DEFAULT_K, seed: int = DEFAULT_SEED, placement: int = DEFAULT_PLACEMENT
) -> DataFrame:
    """Re-segment a gold demographics table with the ``simple`` rule; 9 columns.

    The reference moved the active users into one pandas frame for scikit-learn; here the
    same steps run on Spark ML.
    """
    base = gold_demographics.select(*SEGMENT_COLUMNS[:-1])
    active, inactive = _split_stable(base, inactive_condition("simple"), placement)
    clustered = segmentation_pipeline(_clusters(active, k), seed).fit(active).transform(active)
    return _finish(clustered, inactive).select(*SEGMENT_COLUMNS)


def active_features(
    demographics: DataFrame, as_of: dt.date | str, min_minutes: float = SCORE_MIN_MINUTES,
    placement: int = DEFAULT_PLACEMENT,
) -> DataFrame:
    """Scaled features of the active users (input of the model-quality checks), over the stored
    active users."""
    df = with_account_age(demographics, as_of)
    active, _ = _split_stable(df, inactive_condition("rate", RATE_RULE_MIN_RATE, min_minutes), placement)
    return Pipeline(stages=[assembler(), scaler()]).fit(active).transform(active)


def silhouette(spark: SparkSession, clustered: DataFrame) -> DataFrame:
    """Silhouette of a clustering (squared Euclidean), as a one-row frame."""
    evaluator = ClusteringEvaluator(
        predictionCol="cluster", featuresCol="scaled_features", metricName="silhouette"
    )
    return spark.createDataFrame([(float(evaluator.evaluate(clustered)),)], "silhouette double")


def k_sweep(
    spark: SparkSession, scaled: DataFrame, ks=range(2, 9), seed: int = DEFAULT_SEED
) -> DataFrame:
    """Silhouette per k (the data of the elbow plot). Each k is a distributed fit
    over the same stored active users."""
    evaluator = ClusteringEvaluator(
        predictionCol="cluster", featuresCol="scaled_features", metricName="silhouette"
    )
    scores = []
    for k in ks:
        predicted = kmeans(k, seed).fit(scaled).transform(scaled)
        scores.append((int(k), float(evaluator.evaluate(predicted))))
    return spark.createDataFrame(scores, "k int, silhouette double")


def whales_by_country(segments: DataFrame) -> DataFrame:
    """Q11: whales per country, most first."""
    return (
        segments.filter(F.col("user_segment") == WHALE)
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("whales"))
        .orderBy(F.col("whales").desc(), F.col("country").asc_nulls_last())
    )


# ---------------------------------------------------------------- persistence (M9)


def save_model(model, base_path: str, version: str, production: bool = True) -> str:
    """Save ``model`` (a Spark ML pipeline, or a segmentation in whole numbers) under
    ``base_path/version``; optionally make it the production model.

    Every publication adds a line to ``base_path/production`` (a file of its own, committed by the
    write), and nothing is overwritten there: a reader finds the old pointer or the new one, never
    none. All on the shared storage, through Spark."""
    path = f"{base_path.rstrip('/')}/{version}"
    spark = SparkSession.getActiveSession()
    exact = hasattr(model, "to_json")
    if exact:
        spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    else:
        model.write().overwrite().save(path)
    if production:
        folder = f"{base_path.rstrip('/')}/production"
        before = _pointers(spark, folder)
        line = {"number": 1 + max((p["number"] for p in before), default=0), "version": version, "path": path, "exact": exact}
        spark.createDataFrame([(json.dumps(line),)], "value string").coalesce(1).write.mode("append").text(folder)
    return path


def _pointers(spark: SparkSession, folder: str) -> list[dict]:
    """All publications, one a line."""
    try:
        return [json.loads(r["value"]) for r in spark.read.text(folder).collect()]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def load_model(base_path: str, version: str | None = None):
    """Load a saved version, or the one published last (of equal numbers, from publishers at one
    time, the greater version)."""
    from meeple.plans.exact_segments import ExactModel

    spark = SparkSession.getActiveSession()
    lines = _pointers(spark, f"{base_path.rstrip('/')}/production")
    if version is None:
        if not lines:
            raise FileNotFoundError(f"no production model under {base_path}")
        path = max(lines, key=lambda p: (p["number"], p["version"]))["path"]
    else:
        path = f"{base_path.rstrip('/')}/{version}"
    try:
        return PipelineModel.load(path)
    except Exception:  # noqa: BLE001 - not a pipeline: a model in whole numbers is one line of text
        return ExactModel.from_json(spark.read.text(path).first()["value"])
