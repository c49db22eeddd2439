"""Database tables, read in parallel where a split column is given."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark.layout import Database


@dataclass(frozen=True)
class Split:
    """Cut a table into ``parts`` ranges of a numeric, date or timestamp column.

    Bounds only set the stride: rows outside them and rows with a null still arrive, in
    the first or last part. Bounds left out are asked of the database.
    """

    column: str
    parts: int
    lower: object = None
    upper: object = None


@dataclass(frozen=True)
class HashSplit:
    """Cut a table into ``parts`` by a hash of a key that the database computes.

    Parts are even whatever the key looks like. Rows without a key come with the first part. A database whose
    hash is not known here is read in one part.
    """

    column: str
    parts: int

    def conditions(self, url: str) -> list[str]:
        """One condition for each part, in the database's own words."""
        if url.startswith("jdbc:mysql:"):
            part = f"MOD(CRC32({self.column}), {self.parts})"
        elif url.startswith("jdbc:postgresql:"):
            part = f"MOD(ABS(CAST(hashtext(CAST({self.column} AS text)) AS bigint)), {self.parts})"
        else:
            return ["1 = 1"]
        return [f"{part} = {k}" + (f" OR {self.column} IS NULL" if k == 0 else "") for k in range(self.parts)]


@dataclass(frozen=True)
class SourceTable:
    """A database table, the bronze table it feeds and the column that splits it, by hash or by range."""

    table: str
    bronze: str
    tag: str
    split_column: str
    hashed: bool = False

    def split(self, parts: int) -> Split | HashSplit:
        return HashSplit(self.split_column, parts) if self.hashed else Split(self.split_column, parts)


# The source tables, with their bronze names and source tags. Users and titles are split by
# their ids: their times of creation are those of the load, so ranges of them would be one part.
USERS = SourceTable("users", "users", "mysql", "user_id", hashed=True)
SUBSCRIPTIONS = SourceTable("subscriptions", "subscriptions", "mysql", "start_date")
CONTENT = SourceTable("content_catalogue", "content", "postgres", "content_id", hashed=True)
RATINGS = SourceTable("ratings", "ratings", "postgres", "rating_id")

DATABASE_TABLES = (USERS, SUBSCRIPTIONS, CONTENT, RATINGS)


def column_bounds(spark: SparkSession, database: Database, table: str, column: str) -> tuple[object, object]:
    """Lowest and highest value of a column; the database computes them and sends one row."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.jdbc(database.url, query, properties=database.properties()).select(
        F.col("lo").cast("string"), F.col("hi").cast("string")
    ).first()
    return row[0], row[1]


def read_database_table(
    spark: SparkSession, database: Database, table: str, split: Split | HashSplit | None = None
) -> DataFrame:
    properties = database.properties()
    if split is None or split.parts <= 1:
        return spark.read.jdbc(database.url, table, properties=properties)
    if isinstance(split, HashSplit):
        return spark.read.jdbc(database.url, table, predicates=split.conditions(database.url), properties=properties)
    lower, upper = split.lower, split.upper
    if lower is None or upper is None:
        found = column_bounds(spark, database, table, split.column)
        lower, upper = (given if given is not None else seen for given, seen in zip((lower, upper), found))
    if lower is None:  # an empty table, or one whose split column is null throughout
        return spark.read.jdbc(database.url, table, properties=properties)
    return spark.read.jdbc(
        database.url,
        table,
        column=split.column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=split.parts,
        properties=properties,
    )
