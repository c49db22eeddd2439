"""Awkward documents: nulls, empty and very long texts, ties, repeated rows, columns whose names clash."""

from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
EXTRA = "item long, key_ long, part string, body string, label_ int, block long, copies int, size string, found_here int, bucket_ int, shard string, detections string, features string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"

LONG = " ".join(f"wort{i % 997} the{i % 13}" for i in range(60_000))
ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, "The the of and to in it is on by with from at be this that for", None, "a", 3),
    (4, "The the of and to in it is on by with from at be this that for", None, "a", 3),
    (4, "The the of and to in it is on by with from at be this that for", None, "a", 3),
    (None, "Der die das und ein eine von mit für ist nicht auf dem den des", "de", "b", 5),
    (None, None, None, None, None),
    (7, LONG, "de", "b", len(LONG)),
    (8, " \t\n\r\x0b\x0c ", "en", "c", 7),
    (9, "12345 678 !!! ###", "en", "c", 17),
    (10, "Été à la forêt, où l’été s’achève \U0001f600 日本語のテキスト <|endoftext|>", "fr", "é", 60),
    (-5, "mit license", "en", "z", 11),
]


def awkward(spark):
    extra = [None] * EXTRA.count(",") + [None]
    return spark.createDataFrame([(*row, *extra) for row in ROWS], SCHEMA)


def nothing(spark):
    return awkward(spark).where(F.lit(False))


def labels(spark):
    return spark.createDataFrame(
        [(3, 1, 0), (4, 1, 0), (7, 0, 1), (9, 0, None), (10, None, 1), (None, 1, 1), (99, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int"
    )


def conversations(spark):
    rows = [(r[0], i % 3 or None, (r[3] or "user") if i % 2 else None, r[1]) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def folder_of(spark, tmp_path, docs, marked=None, talks=None):
    """A folder of tables as the queries read it."""
    (conversations(spark) if talks is None else talks).write.parquet(f"{tmp_path}/conversations.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    (labels(spark) if marked is None else marked).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def key_counts(df, column="doc_id"):
    return sorted((r[column] for r in df.collect()), key=lambda x: (x is not None, x))
