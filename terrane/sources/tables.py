"""Tables and delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrane.functions.numbers import number_or_null
from terrane.functions.predicates import quoted

# Names of the delimiters, and the texts that mean "missing".
DELIMITERS = {None: ",", "comma": ",", "tab": "\t", "space": " "}
MISSING = "*"


def load_table(
    spark: SparkSession, name: str, root: str | None = None, schema: str | None = None
) -> DataFrame:
    """A catalog table, or with ``root`` the Parquet file of that name. A declared
    schema spares the job that reads it from the files."""
    if root is None:
        return spark.table(name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_delimited(
    spark: SparkSession,
    path: str,
    delimiter: str | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Delimited text with a header. Without a schema the types are inferred, which
    reads the data twice. ``*`` and empty fields are NULL."""
    reader = (
        spark.read.option("header", True)
        .option("sep", DELIMITERS.get(delimiter, delimiter))
        .option("nullValue", "")
        .option("nanValue", "NaN")
    )
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return missing_to_null(reader.csv(path))


def missing_to_null(df: DataFrame) -> DataFrame:
    """``*`` in text columns and NaN in number columns become NULL."""
    columns = []
    for name, kind in df.dtypes:
        c = quoted(name)
        if kind == "string":
            c = F.nullif(c, F.lit(MISSING))
        elif kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        columns.append(c.alias(name))
    return df.select(*columns)


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the named columns to double; what is no number becomes NULL."""
    return df.withColumns({c: number_or_null(quoted(c)) for c in columns})


def write_delimited(
    df: DataFrame, path: str, delimiter: str | None = "tab", by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Delimited text with a header, as one folder or one folder per value of ``by``."""
    writer = (
        df.write.mode(mode).option("header", True)
        .option("sep", DELIMITERS.get(delimiter, delimiter))
    )
    if by:
        writer = writer.partitionBy(*by)
    writer.csv(path)


def write_by(df: DataFrame, by: str, path: str, mode: str = "overwrite") -> None:
    """One Parquet folder per value of ``by``."""
    df.write.mode(mode).partitionBy(by).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Append rows; the folder is made when missing."""
    df.write.mode("append").parquet(path)
