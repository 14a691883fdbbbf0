"""What several operators share: reading tables, working tables, nulls and repeated rows."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from thermoflow.session import working_path

#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed and return.
BLANKS = r"[ \t-\r]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a fresh table in the shared folder and read again.

    It cuts the lineage: a task lost later starts from files that every executor can read.
    """
    path = working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Functions that run in Python workers import it there. Spark serves the file from the driver.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):
        path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array, without empty ones."""
    return F.array_remove(F.split(text, BLANKS), "")


def packed(columns: list[str]) -> Column:
    """The columns as fields of one, also if there are none, so that their names clash with nothing."""
    return F.struct(F.lit(0).alias("_" * (1 + max(map(len, columns), default=0))), *columns)
