"""Machine-learning stages on Spark ML: splits, scaling, logistic
regression, random forest, calibrated boosted-tree ensemble, edge weather
classifier, isolation forest, autoregressive temperature forecast and
bootstrap augmentation."""

from __future__ import annotations

import functools
import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulus.operators import boosting as B
from cumulus.operators import forest as CF
from cumulus.operators import joins as J
from cumulus.operators import windows as W
from cumulus.operators.series import DEFAULT, SeriesSpec
from cumulus.plans.composed import FEATURES
from cumulus.session import checkpoint_dir

SEED = 42


# ---------------------------------------------------------------- data preparation

def training_matrix(readings: DataFrame, label: str = "cloudburst", spec: SeriesSpec = DEFAULT) -> DataFrame:
    """Generated rolling columns (row based), location code fitted on the
    same readings, the 13 model columns with missing values 0, plus keys and
    label."""
    g = W.generated_rolling(readings, spec=spec)
    codes = J.fit_location_codes(g, spec.keys[0])
    g = J.encode_location(g, codes, spec.keys[0])
    cols = [*spec.keys, spec.ts, *FEATURES] + ([label] if label in g.columns else [])
    return g.select(*cols).na.fill(0.0, subset=FEATURES)


def edge_training(spark, sf_dir: str) -> DataFrame:
    """Edge-model rows (Temp, Humidity, Pressure, Weather_Label) from the
    station readings; the class comes from rain bands (0 < 5 mm, 1 < 15 mm,
    2 < 30 mm, else 3)."""
    from cumulus.sources import fixtures as fx
    g = fx.sensor_grid(spark, sf_dir)
    lab = (F.when(F.col("rainfall_mm") < 5, 0).when(F.col("rainfall_mm") < 15, 1)
            .when(F.col("rainfall_mm") < 30, 2).otherwise(3))
    return g.select("location_id", "timestamp", F.col("temperature").alias("Temp"),
                    F.col("humidity").alias("Humidity"), F.col("pressure").alias("Pressure"),
                    lab.alias("Weather_Label"))


def _label_rank(df: DataFrame, label: str, keys: list[str], seed: int) -> DataFrame:
    """Adds ``_rank`` (1..n within the label, in the order of a seeded hash of the
    keys) and ``_n``.  Ranks come from counts per (label, hash range) and a running
    count inside the range, so no label is sorted in one task."""
    def text(k):
        c = F.col(k)
        return F.unix_micros(c).cast("string") if isinstance(df.schema[k].dataType, T.TimestampType) else c.cast("string")
    h = F.md5(F.concat_ws("|", *[text(k) for k in keys], F.lit(str(seed))))
    x = df.withColumn("_h", h).withColumn("_part", F.substring("_h", 1, 3))
    parts = x.groupBy(label, "_part").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(label).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col(label).alias("_label"), "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_ahead"),
                         F.sum("_c").over(Window.partitionBy(label)).alias("_n")).withColumnRenamed("_part", "_p")
    inside = F.row_number().over(Window.partitionBy(label, "_part").orderBy("_h", *keys))
    x = x.withColumn("_i", inside).join(parts, (F.col(label).eqNullSafe(F.col("_label"))) & (F.col("_part") == F.col("_p")))
    return x.withColumn("_rank", F.col("_ahead") + F.col("_i")).drop("_h", "_part", "_p", "_label", "_ahead", "_i")


def stratified_split(df: DataFrame, label: str, test_fraction: float, keys: list[str],
                     seed: int = SEED) -> DataFrame:
    """Adds ``is_test``: exactly the rounded share of each label's rows, drawn by a
    seeded hash of the keys."""
    x = _label_rank(df, label, keys, seed)
    share = F.floor(F.col("_n") * F.lit(float(test_fraction)) + F.lit(0.5))
    return x.withColumn("is_test", F.col("_rank") <= share).drop("_rank", "_n")


def stratified_folds(df: DataFrame, label: str, k: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """Adds ``fold`` in 0..k-1; within a label fold sizes differ by one at most."""
    x = _label_rank(df, label, keys, seed)
    return x.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def fit_standard_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column from one aggregate row."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0) for c in cols}


def standard_scale(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - mean) / std with population std; std 0 leaves x - mean."""
    x = df
    for c, (m, s) in params.items():
        x = x.withColumn(f"{c}{suffix}", (F.col(c) - F.lit(m)) / F.lit(s if s > 0 else 1.0))
    return x


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (2 n_class) per row from one small count table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = counts.agg(F.sum("_nc").alias("t")).first()["t"]
    counts = counts.withColumn(out, F.lit(float(total)) / (F.lit(2.0) * F.col("_nc"))).drop("_nc")
    return J.attach(df, counts, label, "left")


def positive(prob_col: str = "probability"):
    return vector_to_array(F.col(prob_col)).getItem(1)


# ---------------------------------------------------------------- models

def logreg(train: DataFrame, cols: list[str], label: str, C: float = 1.0, max_iter: int = 1000):
    """L2 logistic regression on already scaled columns (regParam = 1/(C n))."""
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                            regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0, standardization=False)
    return lr.fit(assemble(train, cols))


def random_forest(train: DataFrame, cols: list[str], label: str, num_trees: int = 200,
                  max_depth: int = 30, seed: int = SEED):
    """Random forest with class-balanced weights; depth up to Spark's limit of 30."""
    return grow_forest(balanced_weights(train, label), cols, label, num_trees, max_depth, seed, "weight")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out evenly to many tasks: scoring costs far more than reading, so
    the partitions that suit their bytes are too few."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


#: Trees of a forest that are grown together: what the driver keeps of growing trees is theirs.
TREES_AT_ONCE = 25


class Forest:
    """Forests (of cells, or Spark ML's) that vote as one, each with the weight of its trees."""

    def __init__(self, parts: list):
        self.parts = parts
        self.shares = [m.getNumTrees / sum(m.getNumTrees for m in parts) for m in parts]

    @property
    def featureImportances(self) -> DenseVector:
        """Mean of the trees' importances, as in a single forest."""
        return DenseVector(sum(s * m.featureImportances.toArray() for s, m in zip(self.shares, self.parts)))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (vector) and ``prediction``."""
        x = spread(df)
        if isinstance(self.parts[0], CF.CellForest):
            return CF.vote(self.parts, x)
        names = [f"_p{i}" for i in range(len(self.parts))]
        for m, name in zip(self.parts, names):
            x = m.copy({m.probabilityCol: name, m.rawPredictionCol: "", m.predictionCol: ""}).transform(x)
        def share(s: float):
            return lambda v: v * F.lit(s)  # of one argument: a second one would be the index

        votes = [F.transform(vector_to_array(n), share(s)) for n, s in zip(names, self.shares)]
        total = functools.reduce(lambda a, b: F.zip_with(a, b, lambda v, w: v + w), votes)
        x = x.withColumn("_p", total).drop(*names)
        x = x.withColumn("prediction", (F.array_position("_p", F.array_max("_p")) - 1).cast("double"))
        return x.withColumn("probability", array_to_vector("_p")).drop("_p")


def grow_forest(train: DataFrame, cols: list[str], label: str, num_trees: int, max_depth: int, seed: int,
                weight: str | None = None) -> Forest:
    """A random forest on all rows of ``train``, which must have all values.  The rows are
    stored once and dealt out evenly (a small file is one task otherwise).  Trees grow side by side over the cells of
    equal binned rows; of more than MOST_CELLS cells Spark ML grows the forest."""
    spark = train.sparkSession
    checkpoint_dir(spark)
    own = [label, *([weight] if weight else [])]
    data = train.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(cols) if c not in own], *own)
    tasks = max(spark.sparkContext.defaultParallelism, data.rdd.getNumPartitions())
    data = data.repartition(tasks).checkpoint()
    odd = functools.reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in cols])
    if not data.where(odd).isEmpty():
        raise ValueError("values that a forest is grown on must not be NULL, NaN or infinite")
    edges = B.borders(data, cols, CF.BINS)
    cells = CF.cells_of(data, cols, label, weight, edges).checkpoint()
    size, labelled, least = cells.agg(F.count(F.lit(1)), F.count("y"), F.min("y")).first()
    if not size or labelled < size or least < 0:
        raise ValueError(f"a forest needs rows, and labels of 0 and above in all of them: {label}")
    if size > CF.MOST_CELLS:
        return _spark_forest(data, cols, label, num_trees, max_depth, seed, weight)
    found = CF.collected(cells, len(cols))
    trees = CF.grow_trees(found, edges, num_trees, max_depth, seed, spark)
    return Forest([CF.CellForest(trees[i:i + TREES_AT_ONCE], edges, found.classes, cols)
                   for i in range(0, num_trees, TREES_AT_ONCE)])


def _spark_forest(data: DataFrame, cols: list[str], label: str, num_trees: int, max_depth: int, seed: int,
                  weight: str | None) -> Forest:
    """Spark ML's forest, some trees at a time; rows remember their node, so no pass walks or
    broadcasts the trees grown so far."""
    data = assemble(data, cols).select("features", label, *([weight] if weight else []))
    parts = []
    for i, first in enumerate(range(0, num_trees, TREES_AT_ONCE)):
        rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=min(TREES_AT_ONCE, num_trees - first),
                                    maxDepth=max_depth, seed=seed + i, cacheNodeIds=True)
        parts.append((rf.setWeightCol(weight) if weight else rf).fit(data))
    return Forest(parts)


def feature_importance(model, cols: list[str], spark) -> DataFrame:
    imp = model.featureImportances.toArray().tolist()
    rows = sorted(zip(cols, imp), key=lambda t: -t[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def platt(scores: DataFrame, raw_col: str, label: str, soft: bool = False):
    """Sigmoid calibration of a raw score: logistic regression on the score.
    ``soft`` uses Platt's target smoothing by giving each row twice, with
    weights t and 1 - t."""
    x = scores.select(F.col(raw_col).alias("_raw"), F.col(label).cast("double").alias("_y"))
    if soft:
        n_pos = x.where("_y = 1").count()
        n_neg = x.where("_y = 0").count()
        t_pos, t_neg = (n_pos + 1.0) / (n_pos + 2.0), 1.0 / (n_neg + 2.0)
        t = F.when(F.col("_y") == 1, t_pos).otherwise(t_neg)
        x = (x.withColumn("_t", t)
              .select("_raw", F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("_t").alias("w")),
                                                F.struct(F.lit(0.0).alias("y"), (1 - F.col("_t")).alias("w")))).alias("_e"))
              .select("_raw", F.col("_e.y").alias("_y"), F.col("_e.w").alias("_w")))
    else:
        x = x.withColumn("_w", F.lit(1.0))
    lr = LogisticRegression(featuresCol="_f", labelCol="_y", weightCol="_w", regParam=0.0, maxIter=100)
    return lr.fit(VectorAssembler(inputCols=["_raw"], outputCol="_f").transform(x))


# The seeds of the ensemble.
ENSEMBLE_SEEDS = (42, 10, 77, 123, 2024)


def hashed_folds(df: DataFrame, k: int, keys: list[str], seed: int) -> DataFrame:
    """Adds ``fold`` in 0..k-1 by a seeded hash of the row's keys alone: the same for
    the row in any sample of the table."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*keys, F.lit(f"fold-{seed}")), F.lit(k)).cast("int"))


def ensemble_rows(train: DataFrame, cols: list[str], label: str, seeds, folds: int, keys: list[str],
                  fit_rows: int | None = None) -> DataFrame:
    """The labelled rows of each fit (``_seed``, ``_held``) one by one, all of them unless
    a caller asks for about ``fit_rows``: those whose fold is ``_held`` calibrate it, the
    others train it.  The fits read the same rows packed (ensemble_parts)."""
    rows = train.where(F.col(label).isNotNull())
    if fit_rows is not None:
        draw = F.pmod(F.xxhash64(*keys, F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        rows = rows.where(draw < F.lit(fit_rows / max(rows.count(), 1)))
    rows = rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("int").alias("_y"))
    dealt = None
    for s in seeds:
        part = hashed_folds(rows, folds, keys, s).withColumn("_seed", F.lit(s))
        dealt = part if dealt is None else dealt.unionByName(part)
    return dealt.withColumn("_held", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))


def ensemble_parts(train: DataFrame, cols: list[str], label: str, seeds, folds: int, keys: list[str],
                   edges: list[np.ndarray]) -> DataFrame:
    """All labelled rows for each fit (``fit`` = number of the seed * folds + held fold),
    packed: per batch of rows their bin codes (feature x row), labels, folds under the
    seed and a hash of the whole row that orders them, a byte or eight a value."""
    x = train.where(F.col(label).isNotNull())
    values = [F.col(c).cast("double") for c in cols]
    y = F.col(label).cast("int")
    for i, s in enumerate(seeds):
        x = hashed_folds(x, folds, keys, s).withColumnRenamed("fold", f"_fold{i}")
    x = x.select(*[v.alias(f"_{i}") for i, v in enumerate(values)], y.alias("_y"), *[f"_fold{i}" for i in range(len(seeds))],
                 F.xxhash64(*keys, *values, y).alias("_order"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                X = np.column_stack([b[f"_{i}"].to_numpy(dtype=float) for i in range(len(cols))])
                own = [b[f"_fold{i}"].to_numpy().astype(np.uint8).tobytes() for i in range(len(seeds))]
                yield pd.DataFrame({"n": [len(b)], "codes": [B.bin_codes(X, edges).tobytes()],
                                    "y": [b["_y"].to_numpy().astype(np.int32).tobytes()], "folds": [own],
                                    "order": [b["_order"].to_numpy().astype(np.int64).tobytes()]})

    fits = F.explode(F.sequence(F.lit(0), F.lit(len(seeds) * folds - 1)))
    return (x.mapInPandas(pack, "n int, codes binary, y binary, folds array<binary>, order binary").withColumn("fit", fits)
            .select("fit", "n", "codes", "y", F.col("folds")[F.floor(F.col("fit") / folds).cast("int")].alias("fold"), "order"))


def calibrated_ensemble(train: DataFrame, cols: list[str], label: str, seeds=ENSEMBLE_SEEDS, folds: int = 3,
                        rounds: int = 800, keys: list[str] | None = None) -> list[dict]:
    """Per seed and fold: boosted trees (step 0.05, 48 leaves, >= 20 rows per
    leaf, 80 % rows / columns, positive weight neg / pos) fitted on all labelled rows
    of the other folds, sigmoid-calibrated on those of the held-out fold.  Each fit is a
    task of its own and they run side by side.  Returns one dict per (seed, fold), in
    order: seed, fold, trees, a, b."""
    import pickle
    keys = keys or ["location_id", "timestamp"]
    seeds = list(seeds)
    edges = B.borders(train.where(F.col(label).isNotNull()), cols)
    parts = ensemble_parts(train, cols, label, seeds, folds, keys, edges)
    settings = B.Settings(rounds=rounds)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = {name: [] for name in ("codes", "y", "fold", "order")}
        number = None
        for b in batches:
            for r in b.itertuples(index=False):
                number = int(r.fit)
                got["codes"].append(np.frombuffer(r.codes, dtype=np.uint8).reshape(len(cols), r.n))
                got["y"].append(np.frombuffer(r.y, dtype=np.int32))
                got["fold"].append(np.frombuffer(r.fold, dtype=np.uint8))
                got["order"].append(np.frombuffer(r.order, dtype=np.int64))
        if number is None:
            return
        # in the order of the rows' hashes, whatever order they came in
        at = np.argsort(np.concatenate(got.pop("order")), kind="stable")
        codes = np.concatenate(got.pop("codes"), axis=1)[:, at]
        y, out = np.concatenate(got.pop("y"))[at], np.concatenate(got.pop("fold"))[at] == number % folds
        del at
        seed, held = int(seeds[number // folds]), number % folds
        kept = codes[:, out]
        codes = codes[:, ~out]
        trees = B.fit_codes(codes, edges, y[~out], settings, seed * 31 + held)
        a, b = B.platt(trees.margin_of(kept), y[out])
        yield pd.DataFrame({"seed": [seed], "fold": [held], "trees": [pickle.dumps(trees)], "a": [a], "b": [b]})

    got = (parts.repartitionById(len(seeds) * folds, F.col("fit"))
           .mapInPandas(fit, "seed int, fold int, trees binary, a double, b double")).collect()
    return [{"seed": r.seed, "fold": r.fold, "trees": pickle.loads(r.trees), "a": r.a, "b": r.b}
            for r in sorted(got, key=lambda r: (seeds.index(r.seed), r.fold))]


def row_mean(cols) -> "F.Column":
    """Mean over the models' probabilities of a row."""
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / F.lit(float(len(cols)))


def ensemble_predict(df: DataFrame, models: list[dict], cols: list[str], out: str = "probability_mean") -> DataFrame:
    """Mean over seeds of the mean over folds of the calibrated positive-class
    probability."""
    shared = df.sparkSession.sparkContext.broadcast(models)
    seeds = sorted({m["seed"] for m in models})

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def by_seed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        models = shared.value
        for parts in batches:
            X = np.column_stack([p.to_numpy(dtype=float) for p in parts])
            p = np.zeros((len(X), len(seeds)))
            for m in models:
                z = m["a"] * m["trees"].margin(X) + m["b"]
                p[:, seeds.index(m["seed"])] += 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            p /= len(models) / len(seeds)
            yield pd.Series(list(p))

    x = spread(df).withColumn("_p", by_seed(*[F.col(c).cast("double") for c in cols]))
    return x.withColumn(out, row_mean([F.col("_p")[i] for i in range(len(seeds))])).drop("_p")


def load_or_train(spark, path: str, train, load, save):
    """The model stored below ``path``; if there is none, or it can't be read, it is
    trained and stored.  The mark of a finished save is written last, so a save that was
    cut short counts as none."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/saved")
    fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(mark):
        try:
            return load(f"{path}/model")
        except Exception as e:  # noqa: BLE001  whatever the reader says about a damaged store
            logging.getLogger(__name__).warning("stored model below %s is trained anew: %s", path, e)
    model = train()
    fs.delete(mark, True)
    save(model, f"{path}/model")
    fs.create(mark, True).close()
    return model


def save_models(spark, models: list[dict], path: str, codes: DataFrame | None = None,
                thresholds: dict | None = None, features: list[str] | None = None) -> None:
    """Model store: trees and calibrators, the location encoder, the thresholds and
    the feature list, below one folder."""
    import json
    import pickle
    rows = [(m["seed"], m["fold"], bytearray(pickle.dumps(m["trees"])), m["a"], m["b"]) for m in models]
    spark.createDataFrame(rows, "seed int, fold int, trees binary, a double, b double").write.mode("overwrite").parquet(f"{path}/models")
    if codes is not None:
        codes.write.mode("overwrite").parquet(f"{path}/encoder")
    meta = json.dumps({"thresholds": thresholds or {}, "features": features or []})
    spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").parquet(f"{path}/meta")


def load_models(spark, path: str) -> tuple[list[dict], dict]:
    """(models, {thresholds, features, encoder}) as saved."""
    import json
    import pickle
    rows = sorted(spark.read.parquet(f"{path}/models").collect(), key=lambda r: (r.seed, r.fold))
    meta = json.loads(spark.read.parquet(f"{path}/meta").first().meta)
    meta["encoder"] = spark.read.parquet(f"{path}/encoder")
    return [{"seed": r.seed, "fold": r.fold, "trees": pickle.loads(r.trees), "a": r.a, "b": r.b} for r in rows], meta


# ---------------------------------------------------------------- edge models

EDGE_FEATURES = ["Temp", "Humidity", "Pressure"]


def weather_class(train: DataFrame, num_trees: int = 100, seed: int = SEED):
    """Four-class weather model; confidence = 100 * probability of the
    predicted class, 2 decimals."""
    return grow_forest(train, EDGE_FEATURES, "Weather_Label", num_trees, 30, seed)


def weather_predict(model, df: DataFrame) -> DataFrame:
    from cumulus.operators.joins import class_names
    x = model.transform(assemble(df, EDGE_FEATURES))
    p = vector_to_array("probability")
    x = x.withColumn("class_id", F.col("prediction").cast("int"))
    x = x.withColumn("confidence", F.round(F.lit(100.0) * F.element_at(p, F.col("class_id") + 1), 2))
    x = class_names(x, "class_id", "weather")
    return x.drop("features", "rawPrediction", "probability", "prediction")


def _c_factor(n: int) -> float:
    """Average path length of an unsuccessful search in a BST of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _hash_long(value, seed):
    """Spark's xxhash64 of a long after what ``seed`` is the hash of, over uint64 arrays."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x, r):
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    h = (seed + (p5 + np.uint64(8))) ^ (turned(value * p2, 31) * p1)
    h = turned(h, 27) * p1 + p4
    h ^= h >> np.uint64(33)
    h *= p2
    h ^= h >> np.uint64(29)
    h *= p3
    return h ^ (h >> np.uint64(32))


def _drawn(n_trees: int, share: int):
    """Whether any tree draws a row: pmod(xxhash64(row, tree), 10^9) < share for some tree."""
    @F.pandas_udf(T.BooleanType())
    def some(row: pd.Series) -> pd.Series:
        with np.errstate(over="ignore"):
            own = _hash_long(row.to_numpy().astype(np.int64).view(np.uint64), np.uint64(42))
            out = np.zeros(len(own), dtype=bool)
            for t in range(n_trees):
                out |= _hash_long(np.full(1, t, dtype=np.uint64), own).view(np.int64) % 1_000_000_000 < share
        return pd.Series(out)
    return some


def isolation_forest(df: DataFrame, cols: list[str], n_trees: int = 100, sample: int = 256,
                     contamination: float = 0.05, seed: int = SEED, keys: list[str] | None = None) -> DataFrame:
    """Isolation forest: each tree is grown in a grouped map from at most
    ``sample`` rows of all, picked by a seeded hash per tree (a bounded group
    per tree), the trees (a few hundred nodes each) are broadcast to a
    vectorised scorer.  With s = 2^(-E[h] / c(sample)), anomaly_score is the
    decision value -s - offset, rounded to 4, where offset is the
    ``contamination`` quantile of -s: negative values are anomalies."""
    from cumulus.operators.stats import quantile_values
    keys = keys or ["location_id", "timestamp"]
    spark = df.sparkSession
    n = df.count()
    psi = min(sample, n)
    # every tree draws about 4 * psi of all rows and keeps the psi smallest hashes;
    # rows that no tree draws are dropped before they are copied per tree
    share = int(min(1.0, 4.0 * psi / max(n, 1)) * 1e9)
    row = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    draws = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(n_trees - 1).cast("long")), lambda t: F.struct(
        t.alias("tree"), F.pmod(F.xxhash64(F.col("_row"), t), F.lit(1_000_000_000)).alias("h")))
    rows = df.select(*cols, row.alias("_row"))
    if share < 1_000_000_000:
        # few rows are drawn: they are found a batch at a time, tree by tree below
        rows = rows.where(_drawn(n_trees, share)("_row"))
    cand = (rows.withColumn("_d", F.explode(F.filter(draws, lambda d: d["h"] < share)))
            .select(*cols, F.col("_d.tree").alias("tree"), F.col("_d.h").alias("_h")))
    depth_limit = int(math.ceil(math.log2(max(psi, 2))))
    schema = "tree long, node long, feature int, split double, left long, right long, size long"

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_h").head(psi)
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed * 100_003 + tree)
        X = pdf[cols].to_numpy(dtype="float64")
        out = []
        stack = [(0, np.arange(len(X)), 0)]
        next_id = 1
        while stack:
            node, idx, d = stack.pop()
            if d >= depth_limit or len(idx) <= 1:
                out.append((tree, node, -1, 0.0, -1, -1, len(idx)))
                continue
            f = int(rng.integers(len(cols)))
            lo, hi = np.nanmin(X[idx, f]), np.nanmax(X[idx, f])
            if not lo < hi:
                out.append((tree, node, -1, 0.0, -1, -1, len(idx)))
                continue
            s = float(rng.uniform(lo, hi))
            l_id, r_id = next_id, next_id + 1
            next_id += 2
            out.append((tree, node, f, s, l_id, r_id, len(idx)))
            stack.append((l_id, idx[X[idx, f] < s], d + 1))
            stack.append((r_id, idx[X[idx, f] >= s], d + 1))
        return pd.DataFrame(out, columns=["tree", "node", "feature", "split", "left", "right", "size"])

    # the forest is at most n_trees * (2 * psi - 1) nodes: a bounded broadcast
    forest = cand.groupBy("tree").applyInPandas(grow, schema).toPandas()
    cfac = np.array([_c_factor(i) for i in range(psi + 2)])
    arrays = []
    for _, g in forest.groupby("tree"):
        m = int(g["node"].max()) + 1
        feat, split, height = np.zeros(m, dtype=int), np.zeros(m), np.zeros(m)
        after = np.repeat(np.arange(m), 2).reshape(m, 2)  # children; a leaf is its own
        g = g.sort_values("node")
        for node, f, at, left, right in zip(g["node"], g["feature"], g["split"], g["left"], g["right"]):
            if f >= 0:  # children have higher numbers
                feat[node], split[node], after[node] = f, at, (left, right)
                height[left] = height[right] = height[node] + 1
        size, leaf = g["size"].to_numpy(), g["feature"].to_numpy() < 0
        path = height + np.where(leaf, cfac[np.minimum(size, len(cfac) - 1)], 0.0)
        arrays.append((feat, split, after.ravel(), path, int(height.max())))
    cpsi = _c_factor(psi)
    bc = spark.sparkContext.broadcast(arrays)

    @F.pandas_udf(T.DoubleType())
    def score(*cols_in: pd.Series) -> pd.Series:
        X = np.column_stack([a.to_numpy(dtype="float64") for a in cols_in])
        trees_, flat = bc.value, X.ravel()
        first = np.arange(len(X)) * X.shape[1]
        total = np.zeros(len(X))
        for feat, split, after, path, height in trees_:
            node = np.zeros(len(X), dtype=int)
            for _ in range(height):
                node = after[2 * node + ~(flat[first + feat[node]] < split[node])]
            total += path[node]
        mean_path = total / max(len(trees_), 1)
        return pd.Series(np.power(2.0, -mean_path / cpsi) if cpsi > 0 else np.zeros(len(X)))

    scored = df.withColumn("anomaly_score", score(*[F.col(c) for c in cols]))
    checkpoint_dir(spark)
    scored = scored.checkpoint(eager=True)
    cut = quantile_values(scored, "anomaly_score", [1.0 - contamination])[0] or 0.0
    decision = F.lit(cut) - F.col("anomaly_score")
    return (scored.withColumn("anomaly", (decision < 0).cast("int"))
                  .withColumn("anomaly_score", F.round(decision, 4)))


def temp_forecast(df: DataFrame, col: str = "temperature", spec: SeriesSpec = DEFAULT):
    """Linear regression of the next value on the 3 previous ones; with no
    training rows, a model fitted on a 0.1-per-step ramp from 20."""
    lags = W.ar_lags(df, col, 3, spec=spec)
    feats = ["lag_3", "lag_2", "lag_1"]
    # stored once, as narrow as it is used: the check, the fit and the callers all read it
    checkpoint_dir(df.sparkSession)
    lags = lags.select(*spec.keys, spec.ts, *feats, col).checkpoint()
    train = lags.select(*feats, F.col(col).alias("target"))
    if train.limit(1).count() == 0:
        spark = df.sparkSession
        ramp = [20.0 + 0.1 * i for i in range(10)]
        train = spark.createDataFrame([(ramp[i], ramp[i + 1], ramp[i + 2], ramp[i + 3]) for i in range(7)],
                                      "lag_3 double, lag_2 double, lag_1 double, target double")
    lr = LinearRegression(featuresCol="features", labelCol="target", regParam=0.0)
    return lr.fit(assemble(train, feats)), lags


def _gauss(*parts):
    """Deterministic standard normal from hashes (Box-Muller)."""
    u1 = (F.pmod(F.xxhash64(*parts, F.lit(1)), F.lit(2 ** 31)) + F.lit(1)) / F.lit(float(2 ** 31 + 1))
    u2 = F.pmod(F.xxhash64(*parts, F.lit(2)), F.lit(2 ** 31)) / F.lit(float(2 ** 31))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def bootstrap_augment(df: DataFrame, min_rows: int, noise=(0.8, 3.0, 2.0), seed: int = SEED,
                      label: str = "Weather_Label", batch: int = 5) -> DataFrame:
    """Below ``min_rows``: append noisy copies in batches of ``batch`` until at least
    ``min_rows`` rows exist.  Each copy draws its source row with replacement: source
    rows are numbered 0..n-1 (number within the partition plus the sizes of those
    before), a copy's seeded hash names a number, and the two meet in an equi-join.
    Temp, Humidity and Pressure get N(0, s) noise from hashed Box-Muller draws;
    labels are kept."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    base = df.select(*EDGE_FEATURES, label)
    numbered = base.withColumn("_id", F.monotonically_increasing_id()).checkpoint(eager=True)
    base = numbered.drop("_id")
    n = numbered.count()
    if n >= min_rows or n == 0:
        return base
    need = -(-(min_rows - n) // batch) * batch
    numbered = numbered.withColumn("_part", F.shiftright("_id", 33))
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    ahead = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_ahead"))
    rows = numbered.join(ahead, "_part").withColumn(
        "_row", F.col("_ahead") + F.col("_id").bitwiseAND((1 << 33) - 1))
    copies = spark.range(need).select(F.col("id").alias("_copy"),
                                      F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).alias("_row"))
    out = copies.join(rows, "_row").select(
        *[(F.col(c) + F.lit(s) * _gauss(F.col("_copy"), F.lit(seed), F.lit(i))).alias(c)
          for i, (c, s) in enumerate(zip(EDGE_FEATURES, noise))], label)
    return union_augmented(base, out)


def union_augmented(originals: DataFrame, augmented: DataFrame) -> DataFrame:
    """Originals and stored augmented rows as one training table."""
    return originals.unionByName(augmented.select(*originals.columns))
