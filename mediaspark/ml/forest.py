"""Random-forest classification, shared by the churn and popularity jobs.

A category enters the trees as one number, its share of positive labels. The shares are a written table, joined to the
rows: however many categories there are, none of them goes to the driver and the feature vector keeps its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.sinks.scratch import written

SEED = 42
TREES = 40
DEPTH = 6
TRAINING_SHARE = 80  # of 100
UNKNOWN = "(unknown)"
FOLDS = 5
PRIOR = 20.0  # rows of the average share that are added to each category
BINS = 10_000

# Both classes are declared, so a sample that holds one of them still trains.
TWO_CLASSES = {"ml_attr": {"type": "nominal", "vals": ["0", "1"], "name": "label"}}


def split(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key: the same rows in every run and layout."""
    bucket = F.pmod(F.xxhash64(F.lit(SEED), F.col(key)), F.lit(100))
    return df.filter(bucket < TRAINING_SHARE), df.filter(bucket >= TRAINING_SHARE)


def with_categories(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Copies of the categories in which null and blank text are a category of their own."""
    return df.withColumns({
        f"{c}_category": F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNKNOWN)) for c in categories
    })


def category_counts(labelled: DataFrame, categories: Sequence[str], fold: Column) -> DataFrame:
    """field, category, rows, positives and the same by fold (at most ``FOLDS`` entries), of rows ``with_categories``."""
    values = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"{c}_category").alias("category")) for c in categories))
    long = labelled.select(F.inline(values), fold.alias("fold"), "label")
    counted = long.groupBy("field", "category", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"))
    return counted.groupBy("field", "category").agg(
        F.sum("n").alias("rows"),
        F.sum("p").alias("positives"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "p")))).alias("folds"),
    )


class CategoryShares(Transformer):
    """Adds ``…_share`` for each category: its share of positives, drawn to the average where it has few rows.

    A category without counts has the average. Rows that the counts were made of are given their ``fold``: its rows are
    taken out of the counts first, so that no row's own label is among its features.
    """

    def __init__(self, counts: DataFrame, categories: Sequence[str], average: float):
        super().__init__()
        self.counts, self.categories, self.average = counts, tuple(categories), average

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.encoded(df)

    def encoded(self, df: DataFrame, fold: Column | None = None) -> DataFrame:
        for c in self.categories:
            named = f"{c}_category"
            own = self.counts.where(F.col("field") == c).select(F.col("category").alias(named), F.struct("rows", "positives", "folds").alias(f"{c}_counts"))
            known = F.col(f"{c}_counts")
            rows, positives = F.coalesce(known["rows"], F.lit(0)), F.coalesce(known["positives"], F.lit(0.0))
            if fold is not None:
                inside = F.try_element_at(known["folds"], fold)
                rows, positives = rows - F.coalesce(inside["n"], F.lit(0)), positives - F.coalesce(inside["p"], F.lit(0.0))
            share = (positives + PRIOR * self.average) / (rows + PRIOR)
            df = df.join(own, named, "left").withColumn(f"{c}_share", share).drop(f"{c}_counts")
        return df


def fit(training: DataFrame, categories: Sequence[str], numbers: Sequence[str], key: str | None = None) -> PipelineModel:
    """Categories of any number become shares of positives; folds come from a hash of the key, or of all features."""
    labelled = with_categories(training, categories).withColumn("label", F.col("label").cast("double"))
    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), *([key] if key else [*categories, *numbers])), F.lit(FOLDS))
    average = labelled.agg(F.avg("label")).first()[0] or 0.0
    shares = CategoryShares(written(category_counts(labelled, categories, fold)), categories, average)
    stages = [
        VectorAssembler(inputCols=[*(f"{c}_share" for c in categories), *numbers], outputCol="features"),
        RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED),
    ]
    encoded = shares.encoded(labelled, fold).withMetadata("label", TWO_CLASSES)
    assembler, trees = Pipeline(stages=stages).fit(encoded).stages
    # A copy leaves the training summary behind: it holds the session, which cannot go to tasks.
    return PipelineModel([shares, assembler, trees.copy()])


def score(model: PipelineModel, df: DataFrame, categories: Sequence[str], probability: str) -> DataFrame:
    return model.transform(with_categories(df, categories)).withColumns({
        probability: vector_to_array("probability").getItem(1),
        "prediction": F.col("prediction").cast("int"),
    })


def roc_area(scored: DataFrame, label: str = "label", score: str = "score", bins: int = BINS) -> DataFrame:
    """positives, negatives and area under the ROC curve, as rank sums over a histogram of scores from 0 to 1.

    One row. Scores of one bin count as equal, so only ``bins`` + 1 rows are ordered, however many are scored. Scores
    outside 0 to 1 lie in the first or last bin; rows without label or score are left out; the area is null where one
    of the classes has no row.
    """
    place = F.floor(F.greatest(F.least(F.col(score), F.lit(1.0)), F.lit(0.0)) * bins)
    known = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    histogram = known.groupBy(place.alias("bin")).agg(F.count_if(F.col(label) > 0).alias("p"), F.count_if(F.col(label) <= 0).alias("n"))
    below = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    ranked = histogram.withColumn("won", F.col("p") * (F.coalesce(below, F.lit(0)) + F.col("n") / 2))
    positives, negatives = (F.coalesce(F.sum(c), F.lit(0)) for c in "pn")
    return ranked.agg(
        positives.alias("positives"), negatives.alias("negatives"),
        F.try_divide(F.sum("won"), positives.cast("double") * negatives).alias("area"),
    )


def area_under_roc(model: PipelineModel, test: DataFrame, categories: Sequence[str]) -> float | None:
    return roc_area(score(model, test, categories, "score")).first()["area"]
