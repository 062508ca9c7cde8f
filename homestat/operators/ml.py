"""Market segments (K-Means) and the price model (linear regression) on Spark ML.

Fitting is distributed by MLlib (k-means|| and normal-equation / L-BFGS
aggregates).  Only model parameters (k centres, 7 coefficients, the category
labels) come back to the driver.  Scoring a table is one projection:
the 7 parameters become literals and the category indexes arrive through a
left equi-join on the label table (broadcast only if Spark's size check
allows it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homestat.constants import COEF_FEATURES, FEATURE_LABELS, METRIC_NAMES, SEGMENT_NAMES
from homestat.operators import kmeans
from homestat.operators.quantiles import exact_quantile
from homestat.operators.ranking import global_rank
from homestat.operators.views import cluster_stats
from homestat.schema import KMEANS_FEATURES, LR_CAT_FEATURES, LR_LABEL, LR_NUM_FEATURES
from homestat.session import materialize

# ---- K-Means segments --------------------------------------------------------------


def kmeans_input(clean: DataFrame) -> DataFrame:
    return clean.select("listing_id", "property_type", "district", "city", *KMEANS_FEATURES).dropna(
        subset=KMEANS_FEATURES)


def assemble_scale(df: DataFrame) -> Pipeline:
    """Feature vector of the four inputs, standardised to mean 0, std 1."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=KMEANS_FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ])


def zscores(df: DataFrame) -> DataFrame:
    """The standardisation as plain columns (what the scaler computes; 0 for a constant column)."""
    stats = df.agg(*[x for c in KMEANS_FEATURES for x in (F.avg(c).alias(f"{c}_mean"),
                                                            F.stddev_samp(c).alias(f"{c}_std"))]).first()
    return df.select("listing_id", *[
        (((F.col(c) - F.lit(stats[f"{c}_mean"])) / F.lit(stats[f"{c}_std"])) if stats[f"{c}_std"]
         else F.when(F.col(c).isNotNull(), F.lit(0.0))).alias(f"{c}_z")
        for c in KMEANS_FEATURES])


def fit_kmeans(df: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 30) -> PipelineModel:
    """Spark ML's fit (random seeds by partition); ``kmeans.fit`` is the repeatable one."""
    stages = assemble_scale(df).getStages() + [
        KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=max_iter)]
    return Pipeline(stages=stages).fit(df)


def segment_table(stats: DataFrame, names: list[str] = SEGMENT_NAMES) -> DataFrame:
    """cluster -> segment name by ascending average price (ties by cluster id).

    The window runs over the k-row statistics table, never over listings.
    """
    rank = F.row_number().over(Window.orderBy("avg_price", "cluster"))
    labels = F.array(*[F.lit(n) for n in names])
    return stats.select("cluster", F.element_at(labels, rank).alias("segment"))


@dataclass
class Segments:
    clustered: DataFrame
    stats: DataFrame
    stats_named: DataFrame


def segments(clean: DataFrame, k: int = 5, max_iter: int = 30) -> Segments:
    """Fit, assign, name clusters.  ``clean`` is scanned once a step: hand in a written table."""
    data = kmeans_input(clean)
    assigned = kmeans.fit(data, k, max_iter).assign(data)
    # k rows that names, statistics and clustered rows are all made from: the clusters are counted once
    stats = materialize(cluster_stats(assigned), "cluster_stats")
    names = segment_table(stats)
    # names has k rows (k is a parameter, not data-dependent): safe to broadcast.
    clustered = assigned.join(F.broadcast(names), "cluster")
    return Segments(clustered, stats, stats.join(F.broadcast(names), "cluster"))


# ---- linear regression -------------------------------------------------------------


def model_input(clean: DataFrame) -> DataFrame:
    return clean.select("listing_id", *LR_NUM_FEATURES, *LR_CAT_FEATURES, LR_LABEL).dropna()


def string_index(df: DataFrame, column: str) -> DataFrame:
    """label -> index: most frequent first, ties alphabetical (StringIndexer's order).

    Counting is a partial aggregate; labels are ranked over range partitions, so their number
    may grow with the data.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ranked = global_rank(counts, [F.desc("n"), F.asc(column)], "place")
    return ranked.select(F.lit(column).alias("feature"), F.col(column).alias("label"), F.col("place").cast("double").alias("index"))


def split(df: DataFrame, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """80/20 split by a hash of the listing id: the same rows whatever the partitions."""
    digits = F.conv(F.substring(F.md5(F.col("listing_id").cast("string")), 1, 8), 16, 10).cast("long")
    in_train = digits % 10 < train_tenths
    return df.where(in_train), df.where(~in_train)


def fit_regression(train: DataFrame, max_iter: int = 100, reg: float = 0.1, elastic: float = 0.0) -> PipelineModel:
    stages = [
        StringIndexer(inputCol="property_type", outputCol="type_idx", handleInvalid="skip"),
        StringIndexer(inputCol="district", outputCol="dist_idx", handleInvalid="skip"),
        VectorAssembler(inputCols=LR_NUM_FEATURES + ["type_idx", "dist_idx"], outputCol="features"),
        LinearRegression(featuresCol="features", labelCol=LR_LABEL, maxIter=max_iter,
                         regParam=reg, elasticNetParam=elastic),
    ]
    return Pipeline(stages=stages).fit(train)


@dataclass
class PriceModel:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame

    @property
    def lr(self):
        return self.model.stages[-1]


def train_price_model(clean: DataFrame) -> PriceModel:
    # fit, metrics and predictions read the rows a dozen times: they are picked and split once
    train, test = (materialize(part, name) for part, name in zip(split(model_input(clean)), ("train", "test")))
    model = fit_regression(train)
    return PriceModel(model, train, test, model.transform(test))


def metrics(pm: PriceModel) -> DataFrame:
    """R² (4 dp), RMSE and MAE (3 dp) on the test rows, plus train/test sizes.

    All computed in one aggregate over the predictions.
    """
    p = pm.predictions
    err = F.col("prediction") - F.col(LR_LABEL)
    agg = p.agg(
        F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
        F.var_pop(LR_LABEL).alias("var"), F.count(F.lit(1)).alias("n"),
    )
    train_n = pm.train.agg(F.count(F.lit(1)).alias("train_n"))
    row = agg.first()
    r2 = 1 - row["mse"] / row["var"] if row["var"] else float("nan")
    vals = [round(r2, 4), round(row["mse"] ** 0.5, 3), round(row["mae"], 3),
            float(train_n.first()["train_n"]), float(pm.test.count())]
    return p.sparkSession.createDataFrame(list(zip(METRIC_NAMES, vals)), "metric string, value double")


def coefficients(pm: PriceModel) -> DataFrame:
    coefs = [float(x) for x in pm.lr.coefficients.toArray()]
    spark = pm.predictions.sparkSession
    return spark.createDataFrame(list(zip(COEF_FEATURES, coefs)), "feature string, coefficient double")


def sorted_coefficients(coef: DataFrame) -> DataFrame:
    """Ascending, with display label (unknown features keep their name) and sign."""
    labels = F.create_map(*[F.lit(x) for kv in FEATURE_LABELS.items() for x in kv])
    return coef.withColumns({
        "label": F.coalesce(F.try_element_at(labels, F.col("feature")), F.col("feature")),
        "sign": F.when(F.col("coefficient") < 0, "negative").otherwise("positive"),
    }).orderBy("coefficient", "feature")


def predictions(pm: PriceModel, n: int | None = None) -> DataFrame:
    """Actual and predicted price of the test rows; the first ``n`` by listing id if given."""
    rows = pm.predictions if n is None else pm.predictions.orderBy("listing_id", *LR_NUM_FEATURES, LR_LABEL).limit(n)
    return rows.select(
        F.col(LR_LABEL).alias("actual"),
        F.round("prediction", 3).alias("predicted"),
        "property_type", "district", "area_m2",
    )


def category_map(pm: PriceModel) -> DataFrame:
    """(feature, label, index) from the fitted indexers (bounded by the label count)."""
    spark = pm.predictions.sparkSession
    rows = []
    for stage, feature in zip(pm.model.stages[:2], LR_CAT_FEATURES):
        rows += [(feature, label, float(i)) for i, label in enumerate(stage.labels)]
    return spark.createDataFrame(rows, "feature string, label string, index double")


def model_params(pm: PriceModel) -> DataFrame:
    c = [float(x) for x in pm.lr.coefficients.toArray()]
    spark = pm.predictions.sparkSession
    names = ["intercept", "coef_area_m2", "coef_bedrooms", "coef_bathrooms", "coef_floors",
             "coef_property_type", "coef_district"]
    return spark.createDataFrame([tuple([float(pm.lr.intercept)] + c)], ", ".join(f"{n} double" for n in names))


def plot_filter(preds: DataFrame) -> DataFrame:
    """Rows with actual ≤ p95(actual) and predicted ≤ 1.5 · p95."""
    p95 = exact_quantile(preds, "actual", 0.95)
    return preds.where((F.col("actual") <= p95) & (F.col("predicted") <= 1.5 * p95))


# ---- scoring -----------------------------------------------------------------------


#: Label tables up to this many rows are broadcast; larger ones are joined by shuffle.
MAX_BROADCAST_LABELS = 100_000


def with_category_index(listings: DataFrame, category_index: DataFrame) -> DataFrame:
    """``listings`` with property_type_idx and district_idx; unknown labels index 0.0.

    ``category_index`` is (feature, label, index).  It is counted first: a label
    table within ``MAX_BROADCAST_LABELS`` is broadcast, so the listings aren't
    shuffled on a key of a few values.
    """
    small = category_index.limit(MAX_BROADCAST_LABELS + 1).count() <= MAX_BROADCAST_LABELS
    df = listings
    for column in ("property_type", "district"):
        own = category_index.where(F.col("feature") == column).select(
            F.col("label").alias(column), F.col("index").alias(f"{column}_idx"))
        df = df.join(F.broadcast(own) if small else own, column, "left")
    return df.fillna(0.0, ["property_type_idx", "district_idx"])


def score(listings: DataFrame, params: dict[str, float], category_index: DataFrame) -> DataFrame:
    """price = max(0, intercept + Σ coef·x + coef_type·idx(type) + coef_district·idx(district));
    price/m² = price / area · 1000 (0 when area ≤ 0).  Unknown labels index 0.0.
    """
    df = with_category_index(listings, category_index)
    raw = (
        F.lit(params["intercept"])
        + F.lit(params["coef_area_m2"]) * F.col("area_m2")
        + F.lit(params["coef_bedrooms"]) * F.col("bedrooms")
        + F.lit(params["coef_bathrooms"]) * F.col("bathrooms")
        + F.lit(params["coef_floors"]) * F.col("floors")
        + F.lit(params["coef_property_type"]) * F.col("property_type_idx")
        + F.lit(params["coef_district"]) * F.col("district_idx")
    )
    price = F.greatest(F.lit(0.0), raw)
    return df.select(
        *listings.columns,
        price.alias("predicted_price"),
        F.when(F.col("area_m2") > 0, price / F.col("area_m2") * 1000).otherwise(F.lit(0.0)).alias("predicted_price_per_m2"),
    )


def params_dict(params_df: DataFrame) -> dict[str, float]:
    """The one-row parameter table as a dict (7 scalars)."""
    return params_df.first().asDict()
