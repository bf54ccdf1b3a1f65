"""Training and applying the regressors.

One MLlib regressor per target on the assembled feature vector. Trees are grown
level by level on binned features, so training distributes over rows; the
gradient-boosting details of single-machine libraries have no counterpart here
and fitted values differ from theirs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
)
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clean import finite
from ..functions.ratios import from_log, to_log
from ..names import METRICS, SPARSE
from .metrics import best_models, regression_metrics

VECTOR = "features"


@dataclass(frozen=True)
class TreeParams:
    iterations: int = 120
    depth: int = 5
    step: float = 0.06
    bins: int = 128
    min_rows: int = 80
    subsample: float = 1.0
    seed: int = 42


# The boosted-tree settings of the daily and the hourly models.
DAILY_TREES = {
    m: TreeParams(iterations=360, depth=6, step=0.035, min_rows=45, subsample=0.85)
    if m in SPARSE
    else TreeParams(iterations=280, depth=5, step=0.045, min_rows=75, subsample=0.85)
    for m in METRICS
}
HOURLY_TREES = {
    "spend": TreeParams(iterations=900, depth=5, step=0.035, min_rows=45, subsample=0.88),
    "impressions": TreeParams(iterations=900, depth=5, step=0.035, min_rows=45, subsample=0.88),
    "inline_link_clicks": TreeParams(
        iterations=950, depth=5, step=0.035, min_rows=40, subsample=0.88
    ),
    "tracker_conversions": TreeParams(
        iterations=900, depth=5, step=0.030, min_rows=80, subsample=0.88
    ),
    "tracker_revenue": TreeParams(
        iterations=950, depth=5, step=0.028, min_rows=90, subsample=0.88
    ),
}


def with_vector(df: DataFrame, features: list[str], name: str) -> DataFrame:
    """``df`` with the features as one vector ``name``: 0 for what is not finite and for
    columns the frame lacks, sparse where that is smaller. The values are cleaned as one
    array, since an expression per column costs far more to plan and to run."""
    present = set(df.columns)
    values = F.array(*[F.col(f).cast("double") if f in present else F.lit(0.0) for f in features])
    plain = f"_plain_{name}"
    out = df.withColumn(plain, array_to_vector(F.transform(values, finite)))
    # The size is known here; without it the assembler reads a row to learn it.
    sized = VectorSizeHint(inputCol=plain, size=len(features), handleInvalid="optimistic")
    return VectorAssembler(inputCols=[plain], outputCol=name).transform(sized.transform(out)).drop(plain)


def assemble(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Model edge: aligned, finite features as one vector beside ``keep``."""
    return with_vector(df, features, VECTOR).select(*keep, VECTOR)


def boosted_trees(params: TreeParams, loss: str, weighted: bool) -> GBTRegressor:
    trees = GBTRegressor(
        featuresCol=VECTOR,
        labelCol="label",
        predictionCol="raw",
        maxIter=params.iterations,
        maxDepth=params.depth,
        stepSize=params.step,
        maxBins=params.bins,
        minInstancesPerNode=params.min_rows,
        subsamplingRate=params.subsample,
        seed=params.seed,
        lossType=loss,
    )
    if weighted:
        trees = trees.setWeightCol("weight")
    return trees


def fit_targets(
    samples: DataFrame,
    features: list[str],
    targets: dict[str, str],
    trees: dict[str, TreeParams],
    path: str,
    loss: str = "squared",
    weights: dict[str, Column] | None = None,
    labels: dict[str, Column] | None = None,
    early_stop: bool = False,
    metadata: dict[str, str] | None = None,
) -> None:
    """Fits and saves one regressor per target on log1p of the target.

    ``samples`` carries ``split``; the train part is used, with the validation
    part for early stopping when asked. The assembled rows are shared by all
    targets and kept for the time of the fits; a lost block is computed again."""
    names = list(targets)
    weights = weights or {}
    labels = labels or {}
    used = samples.filter(F.col("split").isin("train", "valid") if early_stop else F.col("split") == "train")
    used = used.withColumns(
        {f"_label_{m}": to_log(labels.get(m, F.col(targets[m]))) for m in names}
        | {f"_weight_{m}": weights[m] for m in names if m in weights}
    ).withColumn("holdout", F.col("split") == "valid")
    extra = [c for c in used.columns if c.startswith(("_label_", "_weight_"))]
    rows = assemble(used, features, ["holdout", *extra]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for m in names:
            model = boosted_trees(trees[m], loss, m in weights)
            if early_stop:
                model = model.setValidationIndicatorCol("holdout")
            columns = [VECTOR, "holdout", F.col(f"_label_{m}").alias("label")]
            if m in weights:
                columns.append(F.col(f"_weight_{m}").alias("weight"))
            Pipeline(stages=[model]).fit(rows.select(*columns)).write().overwrite().save(
                f"{path}/{targets[m]}"
            )
    finally:
        rows.unpersist()
    save_metadata(samples.sparkSession, path, features, list(targets.values()), metadata or {})


def save_metadata(
    spark: SparkSession, path: str, features: list[str], targets: list[str], extra: dict[str, str]
) -> None:
    """Feature list, targets and settings of a model folder as a one-row table."""
    row = [(features, targets, {k: str(v) for k, v in extra.items()})]
    schema = "feature_cols array<string>, target_cols array<string>, settings map<string,string>"
    spark.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def read_metadata(spark: SparkSession, path: str) -> dict:
    schema = "feature_cols array<string>, target_cols array<string>, settings map<string,string>"
    row = spark.read.schema(schema).json(f"{path}/metadata").first()
    return row.asDict()


READY = "ready"


def mark_ready(spark: SparkSession, path: str, sampled: bool) -> None:
    """Readiness of a model folder for serving; a run on sampled ads withdraws it."""
    row = spark.createDataFrame([(not sampled,)], "ready boolean")
    row.coalesce(1).write.mode("overwrite").json(f"{path}/{READY}")


def is_ready(spark: SparkSession, path: str) -> bool:
    try:
        row = spark.read.schema("ready boolean").json(f"{path}/{READY}").first()
    except Exception as missing:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(missing):
            return False
        raise
    return bool(row and row["ready"])


class NotReady(Exception):
    """A model folder that is not to be served: never finished, or of sampled ads."""


@dataclass(frozen=True)
class Routing:
    """Model folder per target; targets may come from different folders."""

    folders: dict[str, str] = field(default_factory=dict)

    @classmethod
    def single(cls, path: str) -> Routing:
        return cls({m: path for m in METRICS})

    def require_ready(self, spark: SparkSession) -> None:
        for path in sorted(set(self.folders.values())):
            if not is_ready(spark, path):
                raise NotReady(path)


def predict_targets(
    frame: DataFrame,
    routing: Routing,
    targets: dict[str, str],
    outputs: dict[str, str],
    exponent_bound: float | None = None,
) -> DataFrame:
    """Adds a prediction per target: each model is applied to the same feature
    vector, in the scale it was trained on."""
    spark = frame.sparkSession
    out, metadata, vectors = frame, {}, {}
    for path in sorted(set(routing.folders.values())):
        metadata[path] = read_metadata(spark, path)
        # Folders with the same features share a vector. The models see finite values;
        # the frame keeps its own.
        features = tuple(metadata[path]["feature_cols"])
        if features not in vectors:
            vectors[features] = f"_vector_{len(vectors) + 1}"
            out = with_vector(out, list(features), vectors[features])
        metadata[path]["vector"] = vectors[features]
    for m, path in routing.folders.items():
        info = metadata[path]
        model = PipelineModel.load(f"{path}/{targets[m]}")
        scored = model.transform(out.withColumn(VECTOR, F.col(info["vector"])))
        raw_scale = info["settings"].get(f"scale.{targets[m]}") == "raw"
        value = (
            F.greatest(F.col("raw"), F.lit(0.0))
            if raw_scale
            else from_log(F.col("raw"), exponent_bound)
        )
        out = scored.withColumn(outputs[m], value).drop("raw", VECTOR, "scaled")
    return out.drop(*vectors.values())


@dataclass(frozen=True)
class Candidate:
    """An objective with settings of its own, tried for one target. ``scale`` is that of
    the label; ``params`` are those of :class:`TreeParams` or of the linear model."""

    name: str
    objective: str
    scale: str
    params: dict = field(default_factory=dict)

    def limited(self, iterations: int | None) -> Candidate:
        if iterations is None or self.objective != "absolute":
            return self
        return replace(self, params=self.params | {"iterations": iterations})

    def stages(self) -> list:
        """Trees stop when the validation part gets no better."""
        if self.objective == "absolute":
            trees = boosted_trees(TreeParams(**self.params), "absolute", False)
            return [trees.setValidationIndicatorCol("holdout")]
        scaler = StandardScaler(inputCol=VECTOR, outputCol="scaled")
        common = dict(featuresCol="scaled", labelCol="label", predictionCol="raw") | self.params
        if self.objective == "huber":
            return [scaler, LinearRegression(loss="huber", **common)]
        if self.objective == "poisson":
            return [scaler, GeneralizedLinearRegression(family="poisson", link="log", **common)]
        return [scaler, GeneralizedLinearRegression(family="tweedie", linkPower=0.0, **common)]


def _grid(name: str, objective: str, scale: str, *settings: dict) -> tuple[Candidate, ...]:
    return tuple(Candidate(f"{name}_{n}", objective, scale, s) for n, s in enumerate(settings, 1))


# Settings per objective; the first of each tree grid are fixed values.
SEARCH = {
    "tracker_conversions": (
        *_grid(
            "log_l1", "absolute", "log",
            dict(iterations=1000, depth=5, step=0.025, min_rows=70, subsample=0.90),
            dict(iterations=500, depth=4, step=0.05, min_rows=140, subsample=0.90),
        ),
        *_grid(
            "log_huber", "huber", "log",
            dict(regParam=0.1, epsilon=1.35, maxIter=50),
            dict(regParam=0.6, epsilon=1.85, maxIter=50),
        ),
        *_grid(
            "poisson_raw", "poisson", "raw",
            dict(regParam=1.0, maxIter=25),
            dict(regParam=0.5, maxIter=25),
        ),
    ),
    "tracker_revenue": (
        *_grid(
            "log_l1", "absolute", "log",
            dict(iterations=1100, depth=5, step=0.022, min_rows=90, subsample=0.88),
            dict(iterations=550, depth=4, step=0.044, min_rows=180, subsample=0.88),
        ),
        *_grid(
            "log_huber", "huber", "log",
            dict(regParam=0.1, epsilon=1.35, maxIter=50),
            dict(regParam=0.85, epsilon=1.85, maxIter=50),
        ),
        *_grid(
            "tweedie_raw", "tweedie", "raw",
            dict(regParam=1.0, maxIter=25, variancePower=1.3),
            dict(regParam=0.75, maxIter=25, variancePower=1.6),
        ),
    ),
}
# Fits that run side by side; each keeps one model of bounded size in the driver.
SEARCH_FITS = 3


def objective_search(
    samples: DataFrame,
    features: list[str],
    targets: dict[str, str],
    path: str,
    grid: dict[str, tuple[Candidate, ...]] = SEARCH,
    fits: int = SEARCH_FITS,
    metadata: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Tries every candidate per target, keeps the one with the best validation R2 (ties:
    its name), saves it with its settings, and returns the metrics of all candidates and
    the test metrics of the chosen ones. At most ``fits`` candidates are fitted at a time;
    their jobs share the assembled rows."""
    spark = samples.sparkSession
    kept = ["split", (F.col("split") == "valid").alias("holdout"), *targets.values()]
    rows = assemble(samples, features, kept).persist(StorageLevel.MEMORY_AND_DISK)

    def tried(m: str, candidate: Candidate):
        target = targets[m]
        value = F.greatest(F.col(target), F.lit(0.0))
        label = F.log1p(value) if candidate.scale == "log" else value
        used = F.col("split").isin("train", "valid") if candidate.objective == "absolute" else F.col("split") == "train"
        model = Pipeline(stages=candidate.stages()).fit(rows.filter(used).withColumn("label", label))
        scored = model.transform(rows.filter(F.col("split") != "train"))
        predicted = (
            from_log(F.col("raw"), 20.0)
            if candidate.scale == "log"
            else F.greatest(F.col("raw"), F.lit(0.0))
        )
        table = regression_metrics(
            scored.withColumn("predicted", predicted), ["split"], target, "predicted"
        )
        # A handful of rows: two splits per candidate.
        return model, [
            (target, candidate.name, r["split"], *[None if r[c] is None else float(r[c]) for c in _SCORES])
            for r in table.collect()
        ]

    tasks = {(targets[m], c.name): (m, c) for m in targets for c in grid[m]}
    try:
        with ThreadPool(max(1, min(fits, len(tasks)))) as pool:
            # Pinned threads: the fits keep the session's job group and settings.
            run = inheritable_thread_target(spark)(lambda task: tried(*task))
            found = dict(zip(tasks, pool.map(run, tasks.values(), chunksize=1)))
    finally:
        rows.unpersist()
    schema = "target string, candidate string, split string, " + ", ".join(
        f"{c} double" for c in _SCORES
    )
    table = spark.createDataFrame([row for _, scores in found.values() for row in scores], schema)
    best = best_models(table.filter(F.col("split") == "valid"), ["target"], label="candidate")
    settings, chosen = dict(metadata or {}), []
    for row in best.select("target", "candidate").collect():
        target, name = row["target"], row["candidate"]
        model, candidate = found[target, name][0], tasks[target, name][1]
        model.write().overwrite().save(f"{path}/{target}")
        settings |= {
            f"scale.{target}": candidate.scale,
            f"candidate.{target}": name,
            f"objective.{target}": candidate.objective,
            f"params.{target}": json.dumps(candidate.params, sort_keys=True),
        }
        if candidate.objective == "absolute":
            settings[f"trees.{target}"] = model.stages[-1].getNumTrees
        chosen.append((target, name))
    save_metadata(spark, path, features, list(targets.values()), settings)
    picks = spark.createDataFrame(chosen, "target string, candidate string")
    selected = table.filter(F.col("split") == "test").join(picks, ["target", "candidate"])
    return table, selected.withColumn("split", F.lit("selected_test"))


def chosen_candidates(spark: SparkSession, path: str) -> dict[str, Candidate]:
    """The candidate kept per target column, with its settings, as its folder says."""
    info = read_metadata(spark, path)
    said = info["settings"]
    return {
        t: Candidate(
            said[f"candidate.{t}"], said[f"objective.{t}"], said[f"scale.{t}"],
            json.loads(said[f"params.{t}"]),
        )
        for t in info["target_cols"]
    }


_SCORES = ["rows", "mae", "rmse", "r2", "wmape", "bias"]
