"""Where tables live, and how to reach the source databases."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from mediaspark.session import DEFAULT_FORMAT


@dataclass(frozen=True)
class LakeLayout:
    """A lake folder with bronze, silver and gold layers, in one table format."""

    base: str
    fmt: str = DEFAULT_FORMAT

    def __post_init__(self):
        root = self.base.rstrip("/")
        if root.startswith("s3://"):
            root = "s3a://" + root[len("s3://"):]
        object.__setattr__(self, "base", root)

    def table(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    def bronze(self, name: str) -> str:
        return self.table("bronze", name)

    def silver(self, name: str) -> str:
        return self.table("silver", name)

    def gold(self, name: str) -> str:
        return self.table("gold", name)

    def checkpoint(self, name: str) -> str:
        return self.table("checkpoints", name)


@dataclass(frozen=True)
class Database:
    """Connection of one source database; ``options`` go to the JDBC reader as they are."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    options: dict[str, str] = field(default_factory=dict)

    def properties(self) -> dict[str, str]:
        props = {"driver": self.driver, **self.options}
        if self.user is not None:
            props["user"] = self.user
        if self.password is not None:
            props["password"] = self.password
        return props


# Rows are fetched in pieces; a driver left to itself may hold a whole partition in memory.
FETCH = {"fetchsize": "10000"}


def mysql(host: str, database: str, user: str, password: str, port: int = 3306) -> Database:
    url = f"jdbc:mysql://{host}:{port}/{database}"
    return Database(url, "com.mysql.cj.jdbc.Driver", user, password, {**FETCH, "useCursorFetch": "true"})


def postgres(host: str, database: str, user: str, password: str, port: int = 5432) -> Database:
    return Database(f"jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver", user, password, dict(FETCH))


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path is there, on whichever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on whichever file system it names; one that is not there is no error."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
