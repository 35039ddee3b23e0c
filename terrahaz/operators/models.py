"""Training and batch scoring with Spark ML.

Tree sizes follow the published settings by default and can be reduced. Spark ML tells the
values of a feature apart only by the bins it cuts from a sample of 10,000 rows, so ``fit`` cuts
such bins itself and counts the rows of equal bins: the rounds of a boosted model read the counts,
whose number the bins bound, instead of the rows. That sample is all that reaches the driver.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrahaz.functions import classify as C
from terrahaz.operators import aggregate as A
from terrahaz.operators.features import DELAY_FEATURES, HAZARD_FEATURES
from terrahaz.operators.ordered import auc_roc, split_by_hash, stratified_split
from terrahaz.operators.sizing import materialize


@dataclass(frozen=True)
class Spec:
    """One model: estimator kind, label, trees, depth."""

    name: str
    kind: str
    label: str
    trees: int
    depth: int
    features: tuple[str, ...] = tuple(HAZARD_FEATURES)

    @property
    def is_classifier(self) -> bool:
        return self.kind.endswith("Classifier")


# Model kinds and sizes.
FIRE_RISK = Spec("fire_risk", "GBTClassifier", "fire_risk", 100, 6)
OVERPOP = Spec("hospital_overpop", "RandomForestClassifier", "hospital_overpop", 150, 10)
RESPONSE = Spec("response_time", "RandomForestRegressor", "response_time", 120, 8)
BED_DEMAND = Spec("bed_demand", "GBTRegressor", "bed_demand", 100, 5)
AMBULANCE = Spec("ambulance_calls", "RandomForestRegressor", "ambulance_calls", 100, 8)
DELAY = Spec("flight_delay", "GBTClassifier", "delay", 100, 5, tuple(DELAY_FEATURES))
DELAY_MINUTES_FOREST = Spec("delay_minutes_forest", "RandomForestRegressor", "total_delay_minutes", 100, 10)
DELAY_MINUTES_BOOSTED = Spec("delay_minutes_boosted", "GBTRegressor", "total_delay_minutes", 150, 5)
PAIR_FOREST = Spec("pair_forest", "RandomForestClassifier", "target", 100, 5)
PAIR_BOOSTED = Spec("pair_boosted", "GBTClassifier", "target", 100, 3)
LEARNING_RATE = 0.1
MIN_PER_LEAF = 2
SEED = 42
#: Bins of a feature, and rows that they are cut from: Spark ML's own figures.
BINS = 32
BIN_ROWS = 10_000
#: Rows up to which a forest's bags draw single rows; beyond, slices of equal rows, about so many in all.
BAG_ROWS = 4_000_000
#: Cells or slices that one task of a round reads.
SLICES_PER_TASK = 50_000


def estimator(spec: Spec, trees: int | None = None, depth: int | None = None):
    shared = dict(
        featuresCol="features", labelCol=spec.label, seed=SEED,
        maxDepth=depth or spec.depth, minInstancesPerNode=MIN_PER_LEAF,
    )
    count = trees or spec.trees
    if spec.kind == "GBTClassifier":
        return GBTClassifier(maxIter=count, stepSize=LEARNING_RATE, **shared)
    if spec.kind == "GBTRegressor":
        return GBTRegressor(maxIter=count, stepSize=LEARNING_RATE, **shared)
    if spec.kind == "RandomForestClassifier":
        return RandomForestClassifier(numTrees=count, **shared)
    return RandomForestRegressor(numTrees=count, **shared)


@dataclass
class Trained:
    spec: Spec
    model: PipelineModel
    metrics: DataFrame
    rows: DataFrame
    params: dict = field(default_factory=dict)


def bin_edges(values: np.ndarray, bins: int = BINS) -> list[float]:
    """The thresholds Spark ML's trees choose from, given a feature's values: halfway between
    neighbours while there are at most ``bins`` different ones, else about equally filled."""
    counts = sorted(Counter(values.tolist()).items())
    halfway = [(a + b) / 2.0 for (a, _), (b, _) in zip(counts, counts[1:])]
    if len(counts) <= bins:
        return halfway
    stride = len(values) / bins
    edges, upto, wanted = [], counts[0][1], stride
    for edge, (_, n) in zip(halfway, counts[1:]):
        if abs(upto - wanted) < abs(upto + n - wanted):
            edges.append(edge)
            wanted += stride
        upto += n
    return edges


def _bin(i: int) -> str:
    return f"__bin_{i}"


def binning(spec: Spec, train: DataFrame, rows: int) -> Bucketizer:
    """Feature ``i`` to column ``_bin(i)``, by edges from at most about ``BIN_ROWS`` of the rows."""
    sample = train.select(*[F.col(f).cast("double") for f in spec.features])
    if rows > BIN_ROWS:
        sample = sample.sample(BIN_ROWS / rows, SEED)
    values = np.array(sample.collect(), dtype=np.float64).reshape(-1, len(spec.features))
    # a tree goes left up to and at a threshold, a bucket ends before its border
    borders = [np.nextafter(bin_edges(v) or [0.0], np.inf).tolist() for v in values.T]
    return Bucketizer(
        splitsArray=[[-np.inf, *b, np.inf] for b in borders], inputCols=list(spec.features),
        outputCols=[_bin(i) for i in range(len(borders))], handleInvalid="keep",
    )


def cells(spec: Spec, train: DataFrame, bins: Bucketizer) -> DataFrame:
    """Rows of equal bins as one, with their number ``__n``: per label for a classifier, with the mean label for a
    regressor, whose squared error differs from that of the rows by a constant that no split or leaf depends on."""
    names = bins.getOutputCols()
    # without their metadata, in which bins are names of no order
    ordered = [F.col(c).alias(c, metadata={}) for c in names]
    rows = bins.transform(train.select(spec.label, *spec.features)).select(spec.label, *ordered)
    if spec.is_classifier:
        return rows.groupBy(*names, spec.label).agg(F.count(F.lit(1)).alias("__n"))
    # a missing label is as little allowed as it is in a row
    label = F.coalesce(F.col(spec.label).cast("double"), F.lit(float("nan")))
    return rows.groupBy(*names).agg(F.avg(label).alias(spec.label), F.count(F.lit(1)).alias("__n"))


def weighted(counted: DataFrame) -> DataFrame:
    """Each cell as one row that weighs its number of rows."""
    cells_ = counted.withColumn("__weight", F.col("__n").cast("double")).drop("__n")
    return cells_.repartition(max(1, -(-counted.count() // SLICES_PER_TASK)))


def in_slices(counted: DataFrame, rows: int, most: int | None) -> DataFrame:
    """Each cell as rows of equal ``__weight``, which add up to its number of rows: two, or one for a cell of one row,
    so that the least number of rows in a leaf holds as it is; with ``most``, in proportion up to that in all."""
    n, two = F.col("__n"), F.lit(2).cast("long")
    parts = F.least(n, two if most is None else F.greatest(two, F.ceil(n * F.lit(most / max(rows, 1)))))
    every = counted.agg(F.sum(parts)).first()[0] or 0
    slices = counted.withColumn("__weight", n / parts).withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), parts)))
    return slices.drop("__n").repartition(max(1, -(-every // SLICES_PER_TASK)))


def fit(spec: Spec, train: DataFrame, trees: int | None = None, depth: int | None = None) -> PipelineModel:
    """A boosted model is fitted to counted cells: what every round makes of the rows, from fewer; the least number of
    rows in a leaf is asked of the weights. A classifying forest of more than ``BAG_ROWS`` rows is fitted to cells too:
    its bags then draw slices of equal rows; every row counts."""
    made, boosted = estimator(spec, trees, depth), spec.kind.startswith("GBT")
    rows = train.count() if boosted or spec.is_classifier else 0
    if not rows or not boosted and rows <= BAG_ROWS:
        assembler = VectorAssembler(inputCols=list(spec.features), outputCol="features", handleInvalid="keep")
        fitted = Pipeline(stages=[assembler, made]).fit(train)
        # a copy leaves the training summary behind, which holds the session and so cannot
        # travel to the executors once the session has observed a query
        return fitted.copy()
    bins = binning(spec, train, rows)
    assembler = VectorAssembler(inputCols=bins.getOutputCols(), outputCol="features", handleInvalid="keep")
    counted = materialize(cells(spec, train, bins), "cells")
    if boosted and rows >= 2 * MIN_PER_LEAF:
        # halfway below, so that sums of whole weights are told apart for certain
        made = made.setMinInstancesPerNode(1).setMinWeightFractionPerNode((MIN_PER_LEAF - 0.5) / rows)
        counted = weighted(counted)
    else:
        counted = in_slices(counted, rows, None if boosted else BAG_ROWS)
    fitted = made.setWeightCol("__weight").fit(assembler.transform(counted))
    return PipelineModel([bins, assembler, fitted]).copy()


def predict(spec: Spec, model: PipelineModel, df: DataFrame) -> DataFrame:
    out = model.transform(df).drop(*[_bin(i) for i in range(len(spec.features))])
    if spec.is_classifier:
        out = out.withColumn("probability", F.get(vector_to_array("probability"), 1)).drop("rawPrediction")
    return out.drop("features")


def evaluate(spec: Spec, scored: DataFrame) -> DataFrame:
    """One row of metrics: classification figures with AUC, or regression figures."""
    if not spec.is_classifier:
        return A.regression_metrics(scored, spec.label, "prediction").select(F.lit(spec.name).alias("model"), "*")
    base = A.classification_metrics(scored, spec.label, "prediction")
    return base.crossJoin(auc_roc(scored, spec.label, "probability")).select(F.lit(spec.name).alias("model"), "*")


def train(
    spec: Spec, df: DataFrame, key: str, trees: int | None = None, depth: int | None = None
) -> Trained:
    """Hash split, fit, evaluate on the held-out rows.

    The marked rows are written to the shared folder once: every round of the fit, the
    scoring and the counts read that table.
    """
    filled = df.fillna(0, subset=list(spec.features)).where(F.col(spec.label).isNotNull())
    marked = split_by_hash(filled, key).select(key, spec.label, *spec.features, "is_test")
    return _trained(spec, materialize(marked, "training"), trees, depth)


def _trained(spec: Spec, marked: DataFrame, trees: int | None, depth: int | None) -> Trained:
    model = fit(spec, marked.where(~F.col("is_test")).drop("is_test"), trees, depth)
    scored = predict(spec, model, marked.where("is_test").drop("is_test"))
    params = {"kind": spec.kind, "trees": trees or spec.trees, "depth": depth or spec.depth}
    return Trained(spec, model, evaluate(spec, scored), marked.select(spec.label, "is_test"), params)


def report(trained: Trained) -> DataFrame:
    """One row: size of the model as fitted, rows of both sides, held-out positives (null for
    a regressor) and whether the model does at least as well on the held-out rows as the
    constant that suits them best (the commoner class, or their mean)."""
    spec, ensemble = trained.spec, trained.model.stages[-1]
    y, held = F.col(spec.label).cast("double"), F.col("is_test")
    counts = trained.rows.agg(
        F.count_if(~held).alias("train_rows"), F.count_if(held).alias("test_rows"),
        F.count_if(held & (y == 1)).alias("positives"), F.var_pop(F.when(held, y)).alias("spread"),
    )
    both = counts.crossJoin(trained.metrics)  # one row each
    if spec.is_classifier:
        commoner = F.greatest(F.col("positives"), F.col("test_rows") - F.col("positives"))
        good, positives = F.col("accuracy") * F.col("test_rows") > commoner - 0.5, F.col("positives")
    else:
        good, positives = F.col("mse") <= F.col("spread"), F.lit(None).cast("bigint")
    return both.select(
        F.lit(spec.name).alias("model"), F.lit(len(ensemble.trees)).alias("trees"),
        F.lit(ensemble.getMaxDepth()).alias("depth"), "train_rows", "test_rows",
        positives.alias("test_positives"), good.alias("beats_constant"),
    )


def train_delay_minutes(df: DataFrame, key: str, features: list[str], trees=None, depth=None) -> tuple[list[Trained], DataFrame]:
    """Forest and boosted regressors on the same split; the better one by RMSE."""
    runs = []
    for base in (DELAY_MINUTES_FOREST, DELAY_MINUTES_BOOSTED):
        spec = Spec(base.name, base.kind, base.label, base.trees, base.depth, tuple(features))
        runs.append(train(spec, df, key, trees, depth))
    table = runs[0].metrics.unionByName(runs[1].metrics)
    return runs, A.best_model(table)


def train_binary_pair(
    df: DataFrame, key: str, features: list[str], label: str | None = None, trees=None
) -> list[Trained]:
    """Two classifiers on a generic table with a stratified split.

    The label is ``target`` if present, else the last column.
    """
    label = label or ("target" if "target" in df.columns else df.columns[-1])
    marked = stratified_split(df.fillna(0, subset=features).select(key, label, *features), key, label)
    marked = materialize(marked, "training")
    specs = [Spec(b.name, b.kind, label, b.trees, b.depth, tuple(features)) for b in (PAIR_FOREST, PAIR_BOOSTED)]
    return [_trained(spec, marked, trees, None) for spec in specs]


def score_delays(flights: DataFrame, probability) -> DataFrame:
    """Probability, minutes and severity per flight, from a probability column."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return flights.withColumn("delay_probability", p).select(
        "flight_id",
        "callsign",
        "latitude",
        "longitude",
        "delay_probability",
        C.delay_minutes("delay_probability").alias("estimated_delay_mins"),
        C.delay_severity("delay_probability").alias("delay_severity"),
    )


def feature_importance(spark: SparkSession, trained: Trained) -> DataFrame:
    """Importances as rows, ranked. One row per feature."""
    weights = trained.model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(trained.spec.features, [float(w) for w in weights]))
    return A.rank_features(spark.createDataFrame(rows, "feature string, importance double"))


def node_table(spark: SparkSession, trained: Trained, path: str) -> DataFrame:
    """The fitted ensemble as a table: ``tree, node, feature`` (null in a leaf)``, threshold, left_child, right_child,
    prediction`` (of the node)``, share`` (of the positive class, for forests)``, gain, n`` (training rows) and
    ``tree_weight``. Read off the saved model, so it goes on working without it."""
    ensemble = trained.model.stages[-1]
    ensemble.write().overwrite().save(path)
    names = F.array(*map(F.lit, trained.spec.features))
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "_metadata", "tree_weight").select("treeID", "tree_weight")
    stats = node["impurityStats"]
    share = F.when(F.size(stats) == 2, F.get(stats, 1) / (F.get(stats, 0) + F.get(stats, 1)))
    # weights, which add up to rows: of each class, or before the sum of labels and that of their squares
    by_class = trained.spec.is_classifier and not trained.spec.kind.startswith("GBT")
    n = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if by_class else F.get(stats, 0)
    threshold = F.get(node["split"]["leftCategoriesOrThreshold"], 0)
    first = trained.model.stages[0]
    if isinstance(first, Bucketizer):  # the trees ask for bins: back to the features' own values
        edges = F.array(*[F.array(*map(F.lit, np.nextafter(b[1:-1], -np.inf).tolist())) for b in first.getSplitsArray()])
        threshold = F.get(F.get(edges, node["split"]["featureIndex"]), F.floor(threshold).cast("int"))
    return spark.read.parquet(f"{path}/data").join(F.broadcast(weights), "treeID").select(  # a row per tree
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(inner, F.get(names, node["split"]["featureIndex"])).alias("feature"),
        F.when(inner, threshold).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left_child"), F.when(inner, node["rightChild"]).alias("right_child"),
        node["prediction"].alias("prediction"), share.alias("share"), node["gain"].alias("gain"), F.round(n).cast("long").alias("n"), "tree_weight")


def score_nodes(nodes: DataFrame, df: DataFrame, features: list[str], depth: int, boosted: bool, classify: bool) -> DataFrame:
    """``df`` with ``score`` from a node table alone: every tree is walked down by native expressions over a small array of
    its nodes (as many as the model has, whatever the rows). A boosted classifier's score is the probability of
    its margin, a forest's the mean share, a regressor's the mean or the weighted sum."""
    entry = F.struct("node", "feature", "threshold", "left_child", "right_child", "prediction", "share")
    trees = nodes.groupBy("tree", "tree_weight").agg(F.array_sort(F.collect_list(entry)).alias("nodes"))
    model = trees.agg(F.array_sort(F.collect_list(F.struct("tree", "tree_weight", "nodes"))).alias("__trees"))
    values = F.create_map(*[x for f in features for x in (F.lit(f), F.coalesce(F.col(f).cast("double"), F.lit(0.0)))])

    def leaf(tree):
        def down(at, _):
            n = F.get(tree["nodes"], at)
            goes = F.when(n["feature"].isNull(), at).when(values[n["feature"]] <= n["threshold"], n["left_child"]).otherwise(n["right_child"])
            return goes.cast("int")

        at = F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), down)
        end = F.get(tree["nodes"], at)
        told = end["share"] if classify and not boosted else end["prediction"]
        return told * tree["tree_weight"] if boosted else told

    # one row of the whole model, of a size that the model's parameters bound
    asked = df.crossJoin(F.broadcast(model))
    total = F.aggregate(F.transform("__trees", leaf), F.lit(0.0), lambda s, x: s + x)
    score = total if boosted else total / F.size("__trees")
    return asked.withColumn("score", 1 / (1 + F.exp(-2 * score)) if boosted and classify else score).drop("__trees")


def importance_of_nodes(nodes: DataFrame, boosted: bool) -> DataFrame:
    """``feature, importance`` from the gains in a node table, weighted by rows: a forest's trees count alike, a boosted
    ensemble's by what they gain. Importances add up to one; features that no node asks for are left out."""
    gains = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    if not boosted:
        whole = gains.groupBy("tree").agg(F.sum("g").alias("whole"))
        gains = gains.join(F.broadcast(whole), "tree").where("whole > 0").withColumn("g", F.col("g") / F.col("whole"))
    by_feature = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    total = by_feature.agg(F.sum("g").alias("total"))
    return by_feature.crossJoin(F.broadcast(total)).select("feature", (F.col("g") / F.col("total")).alias("importance"))  # one row


def run_log(spark: SparkSession, trained: Trained, path: str, model_path: str | None = None) -> DataFrame:
    """Append the run's parameters and metrics as rows; optionally save the model."""
    if model_path is not None:
        trained.model.write().overwrite().save(model_path)
    values = trained.metrics.drop("model").first().asDict()
    run = uuid.uuid4().hex
    rows = [(run, trained.spec.name, "param", k, str(v), None) for k, v in trained.params.items()]
    rows += [(run, trained.spec.name, "metric", k, None, None if v is None else float(v)) for k, v in values.items()]
    table = spark.createDataFrame(rows, "run_id string, model string, kind string, name string, text string, value double")
    table.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
    return table
