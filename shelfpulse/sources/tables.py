"""Access to the input tables, from files or over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfpulse.functions import within
from shelfpulse.sources.ledger import names_in
from shelfpulse.sources.schemas import SCHEMAS

#: Fixed value: the folder of rows whose day is null.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Tables:
    """Loads a named table with its declared schema.

    `root` is a folder with one data set per table. With `jdbc`, the options of a Spark
    JDBC read, tables come from a database; `splits` then gives per table the numeric
    column and bounds for a parallel read: ``{"sales": ("order_id", 1, 9_000_000, 64)}``. A
    table without one is not read, as all of it would go through one task.

    `day_columns` names the column with the day of the time stamp: ``{"sales": "sold_day"}``.
    Day limits are put on it: for files laid out by it they leave out whole folders, in a
    database they become part of its query. The newest folder then is known by its name, without
    a look at the rows of older ones.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        fmt: str = "parquet",
        jdbc: Mapping[str, str] | None = None,
        splits: Mapping[str, tuple[str, int, int, int]] | None = None,
        day_columns: Mapping[str, str] | None = None,
    ):
        if (root is None) == (jdbc is None):
            raise ValueError("give either a folder or JDBC options")
        self.spark, self.root, self.fmt = spark, root, fmt
        self.jdbc, self.splits, self.day_columns = jdbc, splits or {}, day_columns or {}

    def load(self, name: str, since: date | None = None, until: date | None = None) -> DataFrame:
        """The table's declared columns; all rows of the days in between, perhaps others too."""
        schema = StructType.fromDDL(SCHEMAS[name])
        if self.jdbc is None:
            day = self.day_columns.get(name)
            found = StructType(list(schema.fields))
            if day and day not in schema.names:
                found = found.add(day, "date")
            loaded = self.spark.read.schema(found).format(self.fmt).load(f"{self.root}/{name}")
            if day:
                loaded = loaded.filter(within(F.col(day), since, until))
            return loaded.select(*schema.names)
        loaded = self.spark.read.format("jdbc").options(**self.jdbc_options(name)).load()
        if name in self.day_columns:
            loaded = loaded.filter(within(F.col(self.day_columns[name]), since, until))
        return conform(loaded, schema)

    def days(self, name: str) -> list[date]:
        """The days of a table's folders, newest first; none for a table not laid out by day."""
        column = self.day_columns.get(name)
        if self.jdbc is not None or not column:
            return []
        names = names_in(self.spark, f"{self.root}/{name}")
        found = [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]
        return sorted((date.fromisoformat(d) for d in found if d != NO_DAY), reverse=True)

    def newest(self, name: str) -> DataFrame | None:
        """The rows of the newest folder that has any, None for a table not laid out by day."""
        found = (self.load(name, day, day) for day in self.days(name))
        return next((rows for rows in found if not rows.isEmpty()), None)

    def jdbc_options(self, name: str) -> dict[str, str]:
        if name not in self.splits:
            raise ValueError(f"splits has no entry for {name}, whose read would be one task")
        column, low, high, parts = self.splits[name]
        bounds = {"partitionColumn": column, "lowerBound": low, "upperBound": high}
        options = {"dbtable": name, **bounds, "numPartitions": parts}
        return {**self.jdbc, **{key: str(value) for key, value in options.items()}}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Keep the declared columns, with the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
