import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediaspark.ml import churn, features, forest, popularity, products, recommend
from tests.helpers import collected, frame, plan_of

D = dt.date


def test_user_features(spark):
    subs = frame(
        spark, "subscription_id string, user_id string, plan_id string, start_date date, end_date date, is_active boolean, duration_days int",
        ("s1", "u1", "A", D(2024, 1, 1), D(2024, 1, 5), False, 4),
        ("s2", "u1", "B", D(2024, 1, 8), D(2024, 1, 12), False, 4),  # the latest
        ("s3", "u2", "A", D(2024, 1, 1), None, True, 30),
        ("s4", "u3", None, D(2024, 1, 1), D(2024, 1, 2), False, 1),
        ("s5", None, "A", D(2024, 1, 1), None, True, 30),
    )
    events = frame(
        spark, "user_id string, content_id string, watch_duration_sec double, event_date date",
        ("u1", "c1", 10.0, D(2024, 1, 3)), ("u1", "c2", 5.0, D(2024, 1, 3)), ("u1", "c1", 1.0, D(2024, 1, 11)),
        ("u1", "c1", 99.0, D(2024, 1, 12)),  # on the last day: too late
        ("u2", "c1", None, D(2024, 1, 30)), ("u2", "c1", 7.0, D(2024, 1, 31)),
    )
    out = features.user_features(subs, events, "2024-01-31")
    assert collected(out) == [
        ("u1", "B", 4, 2, 2.0, 3.0, 16.0, 1.5, 1.0),
        ("u2", "A", 30, 1, 1.0, 1.0, 0.0, 1.0, 0.0),
        ("u3", None, 1, 1, 0.0, 0.0, 0.0, 0.0, 1.0),
    ]


def test_content_features(spark):
    content = frame(
        spark,
        "content_id string, title string, content_type string, genre_array array<string>, language string, content_rating string, "
        "runtime_minutes int, release_year int, budget long, cast_members array<string>",
        ("c1", "A", "m", ["G", "H"], "hi", "U", 90, 2020, 5, ["x"]), ("c2", "B", "m", None, None, None, None, None, None, None),
        ("c3", "C", "m", [], "hi", "U", 1, 1, 1, []), ("c4", "D", "m", ["G"], "hi", "U", 1, 1, 1, []),
        ("unseen", "E", "m", ["G"], "hi", "U", 1, 1, 1, []), ("c5", None, None, ["G"], "hi", "U", 1, 1, 1, []),
    )
    watch = frame(spark, "content_id string, title string, content_type string, total_views long",
                  ("c1", "A", "m", 1), ("c2", "B", "m", 2), ("c3", "C", "m", 3), ("c4", "D", "m", 4), ("c5", None, None, 0))
    rated = frame(spark, "content_id string, title string, content_type string, avg_rating double, rating_count long", ("c1", "A", "m", 4.5, 2))
    out = features.content_features(content, watch, rated)
    assert collected(out, "content_id", "primary_genre", "language", "n_genres", "n_cast", "avg_rating", "rating_count", "label") == [
        ("c1", "G", "hi", 2.0, 1.0, 4.5, 2.0, 0.0), ("c2", "", "", 0.0, 0.0, 0.0, 0.0, 0.0),
        ("c3", "", "hi", 0.0, 0.0, 0.0, 0.0, 1.0), ("c4", "G", "hi", 1.0, 0.0, 0.0, 0.0, 1.0),
        ("c5", "G", "hi", 1.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_dense_ids_have_no_gaps_and_never_change(spark):
    names = spark.range(5000).select(F.concat(F.lit("user-"), F.col("id") % 700).alias("u")).unionByName(
        frame(spark, "u string", (None,))
    )
    first = collected(features.dense_ids(names, "u", "n", buckets=16))
    again = collected(features.dense_ids(names.repartition(13), "u", "n", buckets=16))
    assert sorted(n for _, n in first) == list(range(700)) and first == again
    assert collected(features.dense_ids(names.limit(0), "u", "n")) == []


def test_the_split_is_the_same_in_every_layout(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    training, test = forest.split(df, "k")
    again, _ = forest.split(df.repartition(7), "k")
    assert collected(training) == collected(again)
    assert training.count() + test.count() == 1000 and 700 < training.count() < 900


def test_churn_learns_from_activity(spark):
    table = spark.range(600).select(
        F.concat(F.lit("u"), "id").alias("user_id"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 == 1, " ").otherwise(F.concat(F.lit("P"), F.col("id") % 3)).alias("plan_id"),
        F.lit(10).alias("subscription_duration_days"), F.lit(1).alias("subscriptions_held"),
        *(((F.col("id") % 10) * 1.0).alias(c) for c in ("active_days", "views", "watch_sec", "titles_per_day")),
        F.when(F.col("id") % 10 < 4, 1.0).otherwise(0.0).alias("label"),
    )
    model, area = churn.train(table)
    out = churn.predict(model, table)
    assert out.columns == ["user_id", "plan_id", "subscription_duration_days", "churn_probability", "prediction"]
    assert area > 0.95 and out.count() == 600
    assert out.filter("plan_id IS NULL").count() > 0 and out.filter("plan_id = ' '").count() > 0  # shown as they came
    assert out.filter("churn_probability NOT BETWEEN 0 AND 1 OR prediction NOT IN (0, 1)").count() == 0
    wrong = out.join(table, "user_id").filter("prediction <> label").count()
    assert wrong < 30
    again, _ = churn.train(table.repartition(5))
    assert again.stages[-1].getNumTrees == forest.TREES


def test_shares_of_categories_leave_out_the_own_fold(spark):
    rows = [(f"k{i}", ["a", "b", " ", None, "c"][i % 5] if i < 40 else f"rare{i}", float(i % 3 == 0)) for i in range(60)]
    labelled = forest.with_categories(frame(spark, "key string, plan string, label double", *rows), ["plan"])
    fold = F.pmod(F.xxhash64("key"), F.lit(forest.FOLDS))
    shares = forest.CategoryShares(forest.category_counts(labelled, ["plan"], fold), ["plan"], 0.3)
    named = {r.key: (r.plan_category, r.label, r.fold) for r in labelled.withColumn("fold", fold).collect()}
    assert {c for c, _, _ in named.values()} == {"a", "b", "c", forest.UNKNOWN, *(f"rare{i}" for i in range(40, 60))}
    for given in (None, fold):
        out = shares.encoded(labelled, given)
        assert out.columns == ["plan_category", "key", "plan", "label", "plan_share"]
        for r in out.collect():
            own = named[r.key]
            others = [label for c, label, f in named.values() if c == own[0] and (given is None or f != own[2])]
            assert r.plan_share == pytest.approx((sum(others) + forest.PRIOR * 0.3) / (len(others) + forest.PRIOR))
    unseen = forest.with_categories(frame(spark, "plan string", ("new",)), ["plan"])
    assert shares.transform(unseen).first().plan_share == pytest.approx(0.3)


def test_ten_thousand_categories_leave_the_vector_short(spark):
    table = spark.range(20_000).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.concat(F.lit("P"), F.col("id") % 10_000).alias("plan_id"), F.lit(1).alias("subscription_duration_days"),
        *(F.lit(1.0).alias(c) for c in churn.NUMBERS), (F.col("id") % 10_000 % 2).cast("double").alias("label"),
    )
    model = forest.fit(table, churn.CATEGORIES, churn.NUMBERS, "user_id")
    assert model.stages[-1].numFeatures == 1 + len(churn.NUMBERS)
    assert forest.area_under_roc(model, table, churn.CATEGORIES) > 0.95


def test_area_equals_all_pairs(spark):
    draw = np.random.default_rng(8)
    label, score = draw.integers(0, 2, 300), np.round(draw.random(300), 2)
    rows = [(int(a), float(b)) for a, b in zip(label, score, strict=True)]
    won = [1.0 if a > b else 0.5 if a == b else 0.0 for a in score[label == 1] for b in score[label == 0]]
    scored = frame(spark, "label int, score double", *rows, (None, 0.5), (1, None), (0, float("nan")))
    for dealt in (scored, scored.repartition(7)):
        out = forest.roc_area(dealt).first()
        assert (out.positives, out.negatives) == (label.sum(), 300 - label.sum()) and out.area == pytest.approx(np.mean(won))
    assert forest.roc_area(scored.where("label = 1")).first().area is None
    assert tuple(forest.roc_area(scored.limit(0)).first()) == (0, 0, None)


def test_one_class_still_trains(spark):
    table = spark.range(40).select(
        F.col("id").cast("string").alias("user_id"), F.lit("P").alias("plan_id"), F.lit(1).alias("subscription_duration_days"),
        *(F.lit(1.0).alias(c) for c in churn.NUMBERS), F.lit(0.0).alias("label"),
    )
    model = forest.fit(table, churn.CATEGORIES, churn.NUMBERS)
    assert churn.predict(model, table).agg(F.max("churn_probability")).first()[0] == 0.0


def test_popularity_takes_titles_without_genre_or_language(spark):
    table = spark.range(80).select(
        F.concat(F.lit("c"), "id").alias("content_id"), F.lit("t").alias("title"), F.col("id").alias("total_views"),
        *(F.when(F.col("id") % 3 == 0, "").otherwise("x").alias(c) for c in popularity.CATEGORIES),
        *((F.col("id") % 5).cast("double").alias(c) for c in popularity.NUMBERS), (F.col("id") % 2).cast("double").alias("label"),
    )
    model, _ = popularity.train(table)
    out = popularity.predict(model, table)
    assert out.columns == ["content_id", "title", "primary_genre", "total_views", "popularity_probability", "prediction"]
    assert out.count() == 80


def test_popularity_is_not_told_the_views(spark):
    assert "total_views" not in popularity.NUMBERS + popularity.CATEGORIES


@pytest.fixture(scope="module")
def model(spark):
    pairs = spark.range(400).select(
        (F.col("id") % 20).cast("int").alias("user"), ((F.col("id") * 7) % 30).cast("int").alias("item"),
        (F.col("id") % 5 + 1).cast("float").alias("views"),
    ).groupBy("user", "item").agg(F.sum("views").cast("float").alias("views"))
    return recommend.train(pairs, blocks=2)


@pytest.mark.parametrize("block_bytes", [64 * 1024 * 1024, 4 * recommend.RANK * 7])
def test_best_items_equal_brute_force(model, block_bytes):
    found = {}
    for row in recommend.best_items(model, 10, block_bytes).collect():
        found.setdefault(row["user"], []).append((row["item"], row["score"]))
    items = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    for user in model.userFactors.collect():
        scores = sorted(((float(np.dot(user["features"], v)), i) for i, v in items.items()), reverse=True)
        ours = sorted(found[user["id"]], key=lambda pair: -pair[1])
        assert len(ours) == 10
        assert np.allclose([s for _, s in ours], [s for s, _ in scores[:10]], atol=1e-5)


def factors(spark, rows):
    return spark.createDataFrame(rows, "id int, features array<float>")


@pytest.mark.parametrize("block_rows,group_rows", [(1_000, 1_000), (7, 5), (1, 100)])
def test_products_with_ties_and_zero_factors_equal_brute_force(spark, block_rows, group_rows):
    rng = np.random.default_rng(3)
    vectors = lambda n, scale: [(i, [float(x) for x in rng.integers(-2, 3, 3) * scale(i)]) for i in range(n)]
    users, items = vectors(23, lambda i: i % 3), vectors(31, lambda i: 1 + i % 4)
    found = {}
    for row in products.best_products(factors(spark, users), factors(spark, items), 4, block_rows=block_rows, group_rows=group_rows).collect():
        found.setdefault(row.user, set()).add((row.item, row.score))
    for user, features in users:
        scores = sorted(((float(np.dot(features, v)), i) for i, v in items), key=lambda p: (-p[0], p[1]))[:4]
        assert found[user] == {(i, s) for s, i in scores}


def test_products_of_nothing(spark):
    some, none = factors(spark, [(1, [1.0])]), factors(spark, [])
    assert products.best_products(some, none, 3).count() == products.best_products(none, some, 3).count() == 0
    assert products.best_products(some, some, 3).collect() == [(1, 1, 1.0)]


def test_most_blocks_are_not_met(spark, monkeypatch):
    items = factors(spark, [(i, [1.0 if i < 20 else 0.01, 0.0]) for i in range(400)])
    met = []
    original = products._ranked
    monkeypatch.setattr(products, "_ranked", lambda scored, k: (met.append(k), original(scored, k))[1])
    assert products.best_products(factors(spark, [(i, [1.0, 1.0]) for i in range(10)]), items, 5, block_rows=20).count() == 50
    assert len(met) <= 2  # of 5 rounds


def test_users_travel_once_a_strip_however_small_the_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    unit = lambda n: [(i, [float(x) for x in v / np.linalg.norm(v)]) for i, v in enumerate(rng.normal(size=(n, 8)))]
    users, items = unit(60), unit(70)
    items += [(i + 70, v) for i, v in items]  # copies: equal products, the lower id first
    kept, original = [], products.written
    monkeypatch.setattr(products, "written", lambda df: (kept.append(original(df)), kept[-1])[1])
    as_doubles = lambda rows: spark.createDataFrame(rows, "id int, features array<double>")
    found = products.best_products(as_doubles(users), as_doubles(items), 3, block_rows=2, group_rows=10).orderBy("user", F.desc("score"), "item").collect()
    for user, features in users:
        best = sorted(range(140), key=lambda i: (-round(float(np.dot(features, items[i][1])), 9), i))[:3]
        assert [row.item for row in found if row.user == user] == best
    assert max(df.count() for df in kept) <= 180  # three a user; a row a user and block would be 60 x 32 in the widest round


def test_recommend_names_titles(spark):
    viewers = spark.range(200).select(
        F.concat(F.lit("USR-"), F.col("id") % 12).alias("user_id"), F.concat(F.lit("CNT-"), (F.col("id") * 5) % 17).alias("content_id"),
        F.lit(2).cast("bigint").alias("views"),
    ).distinct().unionByName(frame(spark, "user_id string, content_id string, views bigint", (None, "CNT-1", 5), ("USR-1", None, 5)))
    content = spark.range(17).select(
        F.concat(F.lit("CNT-"), "id").alias("content_id"), F.concat(F.lit("Title "), "id").alias("title"), F.lit("movie").alias("content_type")
    )
    out = recommend.recommend(
        viewers, content, recommend.user_numbers(viewers), recommend.title_numbers(viewers), k=3, blocks=2
    )
    assert out.columns == ["user_id", "recommended_content", "content_type", "recommendation_rank", "score"]
    rows = out.collect()
    assert len(rows) == 36 and {r["recommendation_rank"] for r in rows} == {1, 2, 3}
    assert all(r["recommended_content"].startswith("Title") for r in rows)
