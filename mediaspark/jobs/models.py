"""Train the models on silver and gold tables and write their predictions to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediaspark.jobs.common import arguments, report, session_and_layout
from mediaspark.jobs.gold import VIEWERS
from mediaspark.layout import LakeLayout
from mediaspark.ml import churn, features, popularity, recommend
from mediaspark.sinks.tables import overwrite, row_counts
from mediaspark.sources.tables import read_table

USER_FEATURES = "user_features"
CONTENT_FEATURES = "content_features"
MODEL_METRICS = "model_metrics"
USER_NUMBERS = "user_numbers"
TITLE_NUMBERS = "title_numbers"


def run(spark: SparkSession, layout: LakeLayout, as_of=None, als_blocks: int = 10) -> DataFrame:
    """Returns table and rows. What training reads many times is written first."""

    def silver(name):
        return read_table(spark, layout, "silver", name)

    def gold(name):
        return read_table(spark, layout, "gold", name)

    counts = {}

    def write(name, df, lookup_by=()):
        counts[name] = overwrite(df, layout.gold(name), layout.fmt, lookup_by=lookup_by)

    write(USER_FEATURES, features.user_features(silver("subscriptions"), silver("viewing_events"), as_of))
    write(
        CONTENT_FEATURES,
        features.content_features(
            silver("content_enriched"), gold("content_watch_metrics"), gold("content_ratings_summary")
        ),
    )
    model, churn_area = churn.train(gold(USER_FEATURES))
    write("user_churn_prediction", churn.predict(model, gold(USER_FEATURES)), ["user_id"])
    model, popularity_area = popularity.train(gold(CONTENT_FEATURES))
    write("content_popularity_prediction", popularity.predict(model, gold(CONTENT_FEATURES)))
    areas = [("user_churn_prediction", churn_area), ("content_popularity_prediction", popularity_area)]
    write(MODEL_METRICS, spark.createDataFrame(areas, "model string, area_under_roc double"))
    write(USER_NUMBERS, recommend.user_numbers(gold(VIEWERS)))
    write(TITLE_NUMBERS, recommend.title_numbers(gold(VIEWERS)))
    best = recommend.recommend(
        gold(VIEWERS), silver("content_enriched"), gold(USER_NUMBERS), gold(TITLE_NUMBERS), blocks=als_blocks
    )
    write("user_recommendations", best, ["user_id"])
    return row_counts(spark, counts)


def main() -> None:
    parser = arguments(__doc__)
    parser.add_argument("--as-of", default=None, help="day that counts as today")
    parser.add_argument("--als-blocks", type=int, default=10)
    given = parser.parse_args()
    spark, layout = session_and_layout("models", given)
    report(run(spark, layout, given.as_of, given.als_blocks))
    spark.stop()


if __name__ == "__main__":
    main()
