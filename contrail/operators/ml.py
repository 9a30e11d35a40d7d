"""Learning operators on Spark ML (inventory H1-H17, H19).

Every fit runs as Spark jobs over the cached, checkpointed training set;
features are sparse vectors (one-hot), never a dense 4,780-wide matrix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.features import DELAY_THRESHOLD, delay_flag
from contrail.operators import trees
from contrail.operators.imputing import ModeImputer, category_modes  # noqa: F401
from contrail.operators.metrics import metric_aggs
from contrail.session import stored

# The reference's gates.
MIN_TEST_R2 = 0.6
MAX_TRAIN_TEST_GAP = 0.1
MIN_IMPROVEMENT = 0.02
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8


def hash_bucket(keys: Sequence[str], seed: int = SPLIT_SEED, sep: str = "_") -> F.Column:
    """0..9999 from the first 8 hex digits of md5(key parts + seed); a null part is empty.
    Repeatable across runs, partitionings and engines."""
    parts = []
    for k in keys:
        parts += [F.coalesce(F.col(k).cast("string"), F.lit("")), F.lit(sep)]
    digest = F.md5(F.concat(*parts, F.lit(str(seed))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10000).cast("int")


def hash_split(df: DataFrame, keys: Sequence[str], train_fraction: float = TRAIN_FRACTION,
               seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """H1: deterministic train / test split by a hash of the row key.

    (The reference's shuffled positional split cannot be reproduced row for
    row; this one is stable under re-execution, which ``randomSplit`` on a
    recomputed input is not.)"""
    b = hash_bucket(keys, seed)
    cut = int(round(train_fraction * 10000))
    return df.where(b < cut), df.where(b >= cut)


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """H3 (sklearn semantics): (x - mean) / population std; constant -> 0.
    Moments are one aggregate, applied as literals."""
    m = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        mu, sd = m[f"m_{c}"], m[f"s_{c}"]
        out[c + suffix] = (F.when(F.lit(sd) > 0, (F.col(c) - F.lit(mu)) / F.lit(sd)).otherwise(F.lit(0.0))
                           if sd is not None else F.lit(None).cast("double"))
    return df.withColumns(out)


@dataclass
class FeatureSpec:
    numeric: list[str]
    categorical: list[str] = field(default_factory=list)
    label: str = "label"


def numeric_stages(spec: FeatureSpec, scale: bool = True):
    """Median imputation, then scaling, of the numeric columns."""
    num_in = list(spec.numeric)
    if not num_in:
        return []
    imputed = [f"{c}__imp" for c in num_in]
    stages = [Imputer(inputCols=num_in, outputCols=imputed, strategy="median"),
              VectorAssembler(inputCols=imputed, outputCol="_num_vec", handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="_num_vec", outputCol="_num_scaled", withMean=True, withStd=True))
    return stages


def preprocessing_stages(spec: FeatureSpec, scale: bool = True, numeric: PipelineModel | None = None):
    """H4 - H6: numeric block (median imputation, then scaling) and
    categorical block (nulls take the training mode, then an alphabetical
    index; unknown -> all-zero one-hot), assembled into one sparse
    ``features`` vector.  A fitted ``numeric`` block takes the place of one
    to fit; the indexes of all columns are learnt in one pass.

    The reference imputes numerics with 3-nearest-neighbours; an exact KNN
    needs every incomplete row compared with every donor (a cross product),
    so the large-scale median imputer is used instead."""
    stages = list(numeric.stages) if numeric is not None else numeric_stages(spec, scale)
    cats = list(spec.categorical)
    cat_vecs = [f"{c}__ohe" for c in cats]
    if cats:
        stages.append(ModeImputer(inputCols=cats, outputCols=[f"{c}__mode" for c in cats]))
        stages.append(StringIndexer(inputCols=[f"{c}__mode" for c in cats], outputCols=[f"{c}__idx" for c in cats],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        # The indexer puts unknown values at index numLabels, the last slot;
        # dropLast removes exactly that slot, so they encode as all zeros.
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in cats], outputCols=cat_vecs, dropLast=True))
    parts = (["_num_scaled" if scale else "_num_vec"] if spec.numeric else []) + cat_vecs
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def model_zoo(label: str, seed: int = SPLIT_SEED, n_rows: int | None = None, label_std: float | None = None):
    """The reference's regressors with its hyper-parameters.

    XGBoost / LightGBM are not available; one column-subsampled GBT stands
    in for both (featureSubsetStrategy is per node in Spark)."""
    zoo = {
        "random_forest": RandomForestRegressor(labelCol=label, numTrees=50, maxDepth=10,
                                               featureSubsetStrategy="sqrt", minInstancesPerNode=4, seed=seed),
        "gradient_boosting": GBTRegressor(labelCol=label, maxIter=50, maxDepth=4, stepSize=0.1,
                                          subsamplingRate=0.8, featureSubsetStrategy="sqrt", seed=seed),
        "boosted_colsample": GBTRegressor(labelCol=label, maxIter=50, maxDepth=5, stepSize=0.1,
                                          subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed),
        "linear_regression": LinearRegression(labelCol=label, regParam=0.0, solver="auto"),
    }
    if n_rows and label_std is not None:
        zoo["ridge"] = ridge(label, n_rows, label_std)
    return zoo


def ridge(label: str, n_rows: int, label_std: float, alpha: float = 1.0) -> LinearRegression:
    """Ridge with penalty ``alpha``, intercept not penalised.  Spark scales the label by its
    population std internally, so regParam = alpha * std / n with standardization off."""
    return LinearRegression(labelCol=label, regParam=alpha * label_std / n_rows, elasticNetParam=0.0,
                            standardization=False, solver="auto", maxIter=1000, tol=1e-12)


def fit_pipeline(train: DataFrame, spec: FeatureSpec, estimator, numeric: PipelineModel | None = None) -> PipelineModel:
    return Pipeline(stages=preprocessing_stages(spec, numeric=numeric) + [estimator]).fit(train)


def evaluate(model: PipelineModel, df: DataFrame, label: str) -> dict:
    return evaluate_all({"model": model}, df, label)["model"]


def evaluate_all(models: dict[str, PipelineModel], df: DataFrame, label: str) -> dict[str, dict]:
    """H7 of several whole pipelines on the same rows: one pass scores a row with
    every model, one aggregate gives all metrics."""
    out, names = df, [f"_pred_{i}" for i in range(len(models))]
    for c, model in zip(names, models.values()):
        out = model.transform(out).select(*df.columns, *[x for x in names if x in out.columns], F.col("prediction").alias(c))
    rows = out.where(F.col(label).isNotNull())
    r = rows.agg(*[F.struct(*metric_aggs(label, c)).alias(c) for c in names]).first()
    return {name: {k: r[c][k] for k in ("n", "r2_score", "mae", "rmse", "mse")} for name, c in zip(models, names)}


def barriers(df: DataFrame) -> bool:
    """Whether all tasks of a job can run at once: not where executors come and go."""
    return df.sparkSession.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false").lower() != "true"


def train_and_evaluate(train: DataFrame, test: DataFrame, spec: FeatureSpec,
                       models: dict | None = None, keep=stored):
    """Fit every model on the stored training set,
    metrics on train and test; best = highest test R^2, first wins ties.
    Returns (report rows as dicts, fitted models by name, best name).
    ``keep`` stores the rows of both; rows that are stored already need none.

    The preprocessing is fitted once on the training rows (it does not
    depend on the regressor) and its output is stored, so no fit re-runs imputation, scaling and one-hot encoding.
    Forests and boosted trees learn together from packed rows (``trees``), and
    least squares with them; the other models are fitted side by side, each from
    a thread of its own.  Each
    returned model is still one whole ``PipelineModel``."""
    train, test = (keep(x.select(*spec.numeric, *spec.categorical, spec.label)) for x in (train, test))
    cores = train.sparkSession.sparkContext.defaultParallelism
    if train.rdd.getNumPartitions() < cores:   # small files are read together
        train = train.repartition(cores)
    if models is None:
        s = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(spec.label).alias("sd")).first()
        models = model_zoo(spec.label, n_rows=s["n"], label_std=s["sd"])
    prep = Pipeline(stages=preprocessing_stages(spec)).fit(train)
    labels = [len(x) for st in prep.stages if isinstance(st, StringIndexerModel) for x in st.labelsArray]
    grown = {name: est for name, est in models.items() if barriers(train) and trees.can_learn(est)}
    if grown:
        grown |= {name: est for name, est in models.items() if trees.can_solve(est, len(spec.numeric) + sum(labels))}
    others = {name: est for name, est in models.items() if name not in grown}
    num = vector_to_array("_num_scaled") if spec.numeric else F.array().cast("array<double>")
    vectors = stored(prep.transform(train).select(*["features"] * bool(others), spec.label, num.alias("_num"),
                                                  F.array(*[F.col(f"{c}__idx").cast("int") for c in spec.categorical]).cast("array<int>").alias("_cat")))
    rows, best, best_r2 = [], None, None
    regs, trained = {}, {}
    if others:
        fit = inheritable_thread_target(train.sparkSession)(lambda est: est.fit(vectors))
        with ThreadPool(len(others)) as pool:
            regs |= zip(others, pool.map(fit, others.values(), chunksize=1))
        trained |= evaluate_all({name: PipelineModel(stages=[reg]) for name, reg in regs.items()}, vectors.select("features", spec.label), spec.label)
    if grown:
        for name, (reg, metrics) in trees.fit_all(grown, vectors, len(spec.numeric), labels, spec.label).items():
            regs[name], trained[name] = reg, metrics
    fitted = {name: PipelineModel(stages=[*prep.stages, regs[name]]) for name in models}
    alone = {name: PipelineModel(stages=[regs[name]]) for name in models}
    tested = evaluate_all(alone, prep.transform(test).select("features", spec.label), spec.label)
    for name in fitted:
        tr, te = trained[name], tested[name]
        rows.append({"model": name, "train_r2": tr["r2_score"], "test_r2": te["r2_score"],
                     "test_mae": te["mae"], "test_rmse": te["rmse"], "test_mse": te["mse"],
                     "train_rows": tr["n"], "test_rows": te["n"]})
        if te["r2_score"] is not None and (best_r2 is None or te["r2_score"] > best_r2):
            best, best_r2 = name, te["r2_score"]
    for r in rows:
        r["is_best"] = r["model"] == best
        acc = accept(r["train_r2"], r["test_r2"])
        r["accepted"], r["gap"] = acc["accepted"], acc["gap"]
    return rows, fitted, best


def accept(train_r2: float | None, test_r2: float | None,
           min_r2: float = MIN_TEST_R2, max_gap: float = MAX_TRAIN_TEST_GAP) -> dict:
    """Test R^2 >= 0.6 and train - test R^2 <= 0.1 (gap at 6 dp)."""
    if train_r2 is None or test_r2 is None:
        return {"accepted": False, "gap": None}
    gap = round(train_r2 - test_r2, 6)
    return {"accepted": bool(test_r2 >= min_r2 and gap <= max_gap), "gap": gap}


def decide(challenger_r2: float | None, champion_r2: float | None, has_champion: bool,
           min_improvement: float = MIN_IMPROVEMENT) -> dict:
    """Accept iff R^2 improves by >= 0.02; without a champion the challenger is
    accepted with improvement = its R^2 (champion fields null)."""
    if not has_champion:
        return {"challenger_r2": challenger_r2, "champion_r2": None, "improvement": challenger_r2, "accepted": True}
    imp = None if challenger_r2 is None or champion_r2 is None else challenger_r2 - champion_r2
    return {"challenger_r2": challenger_r2, "champion_r2": champion_r2, "improvement": imp,
            "accepted": bool(imp is not None and imp >= min_improvement)}


def champion_challenger(test: DataFrame, label: str, challenger: PipelineModel,
                        champion: PipelineModel | None, min_improvement: float = MIN_IMPROVEMENT) -> dict:
    """Both whole pipelines score the same raw test rows, in one pass."""
    models = {"challenger": challenger} | ({} if champion is None else {"champion": champion})
    r2 = {k: m["r2_score"] for k, m in evaluate_all(models, test, label).items()}
    return decide(r2["challenger"], r2.get("champion"), champion is not None, min_improvement)


def score(model: PipelineModel, df: DataFrame, threshold: float = DELAY_THRESHOLD,
          keep: Sequence[str] | None = None) -> DataFrame:
    """Input columns + PREDICTED_DELAY + DELAY_CLASS (prediction > 15)."""
    out = model.transform(df).withColumnRenamed("prediction", "PREDICTED_DELAY")
    out = out.withColumn("DELAY_CLASS", delay_flag("PREDICTED_DELAY", threshold))
    cols = list(keep if keep is not None else df.columns) + ["PREDICTED_DELAY", "DELAY_CLASS"]
    return out.select(*cols)


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the whole pipeline (preprocessing + regressor)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def merge_feedback(train: DataFrame, labeled: DataFrame) -> DataFrame:
    """Append labelled feedback rows (feature map already expanded) to
    the training rows; columns missing on either side become null."""
    return train.unionByName(labeled, allowMissingColumns=True)
