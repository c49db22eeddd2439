"""Personal recommendations: implicit ALS on views, best titles per user.

ALS scores every user against every title. Here a user meets only the blocks of titles whose
factors are long enough to hold one of its k best (see ``products``); the result is exact.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediaspark.ml.features import LARGEST_ALS_ID, dense_ids
from mediaspark.ml.products import best_products

SEED = 42
RANK = 10
ITERATIONS = 10
TOP_TITLES = 10
BLOCK_BYTES = 4 * 1024 * 1024


def interactions(viewers: DataFrame, user_ids: DataFrame, content_ids: DataFrame) -> DataFrame:
    """ALS input from views per viewer and title (one row per pair)."""
    return (
        viewers.join(user_ids, "user_id")
        .join(content_ids, "content_id")
        .select(F.col("user").cast("int"), F.col("item").cast("int"), F.col("views").cast("float").alias("views"))
    )


def train(pairs: DataFrame, blocks: int = 10) -> ALSModel:
    """``blocks`` should grow with the cluster. ALS checkpoints to the session's folder if it has one."""
    als = ALS(
        userCol="user",
        itemCol="item",
        ratingCol="views",
        implicitPrefs=True,
        rank=RANK,
        maxIter=ITERATIONS,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        coldStartStrategy="drop",
        seed=SEED,
    )
    return als.fit(pairs)


def best_items(model: ALSModel, k: int = TOP_TITLES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k highest-scoring items of each user, with items in blocks of at most about ``block_bytes``."""
    factors = (table.select("id", "features") for table in (model.userFactors, model.itemFactors))
    return best_products(*factors, k, block_rows=max(1, block_bytes // (8 * model.rank)))


def known_viewers(viewers: DataFrame) -> DataFrame:
    return viewers.filter(F.col("user_id").isNotNull() & F.col("content_id").isNotNull())


def user_numbers(viewers: DataFrame) -> DataFrame:
    """Number of each user. Used several times: write it once."""
    return dense_ids(known_viewers(viewers), "user_id", "user")


def title_numbers(viewers: DataFrame) -> DataFrame:
    """Number of each title. Used several times: write it once."""
    return dense_ids(known_viewers(viewers), "content_id", "item")


def recommend(
    viewers: DataFrame,
    content: DataFrame,
    user_ids: DataFrame,
    content_ids: DataFrame,
    *,
    k: int = TOP_TITLES,
    blocks: int = 10,
) -> DataFrame:
    """Train on views per viewer and title, and name the k best titles of each user.

    The numbers are dense, so they stay within ALS's integer range for up to
    2,147,483,647 users.
    """
    highest = user_ids.agg(F.max("user")).first()[0]
    if highest is not None and highest > LARGEST_ALS_ID:
        raise ValueError(f"{highest + 1} users exceed the range of ALS ids")
    best = best_items(train(interactions(known_viewers(viewers), user_ids, content_ids), blocks), k)
    rank = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("score"), "item"))
    titles = content.select("content_id", F.col("title").alias("recommended_content"), "content_type")
    named = content_ids.join(titles, "content_id", "left")
    return (
        best.withColumn("recommendation_rank", rank)
        .join(user_ids, "user")
        .join(named, "item")
        .select("user_id", "recommended_content", "content_type", "recommendation_rank", "score")
    )
