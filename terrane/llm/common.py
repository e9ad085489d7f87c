"""What several operators share: tables, struct-packed rows, and the bounded label sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that part words in the contracts: space, tab, line feed, VT, FF, CR.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch that a Python task holds and returns at once.
OUT_ROWS = 256
#: Rows of an Arrow batch that Spark hands to it.
IN_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _small_batches(df: DataFrame) -> None:
    """Let Spark hand Python ``IN_ROWS`` rows at a time, unless the session says otherwise;
    its default of 10,000 long texts would be held several times over in every task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if conf.get(name) == "10000":
        conf.set(name, str(IN_ROWS))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of ``OUT_ROWS`` rows; at the end, unused memory goes back to the system."""
    for batch in batches:
        for at in range(0, batch.num_rows, OUT_ROWS):
            yield batch.slice(at, OUT_ROWS)
    pa.default_memory_pool().release_unused()


def arrow_filter(
    df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]], columns: list[str],
) -> DataFrame:
    """Rows of ``df`` for which ``keep``, given the named columns, says so. Nothing is added,
    so no column can clash."""
    _small_batches(df)
    places = [df.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield part.filter(pa.array(keep(part.select(places)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def arrow_map(
    df: DataFrame, per_batch: Callable[[pa.RecordBatch], dict[str, pa.Array]], added: str,
    start: Callable[[], object] | None = None,
) -> DataFrame:
    """``df`` and columns that ``per_batch`` makes of ``OUT_ROWS`` rows at a time.

    ``added`` is their schema in DDL. ``start`` runs once in a task, and ``per_batch``
    then gets what it returned as a second argument. Rows keep their order and columns.
    """
    _small_batches(df)
    fields = T.StructType.fromDDL(added)
    schema = T.StructType([*df.schema.fields, *fields.fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (start(),) if start is not None else ()
        for part in _parts(batches):
            made = per_batch(part, *state)
            columns = [*part.columns, *(made[f.name] for f in fields.fields)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; null is the empty text."""
    return [x if x is not None else "" for x in batch.column(name).to_pylist()]


def packed(docs: DataFrame, *extra: Column) -> DataFrame:
    """All columns as one struct ``row``, so that no added name can clash with them."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *extra)


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def label_sample(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled ids (doc_id, y), the same ones in every run.

    Ids with a null id or label are left out; an id with several labels gets their mean.
    The rows are those with the smallest hashes, so they are spread over all ids.
    """
    one = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col(label).cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~F.isnan("y"))
        .groupBy("doc_id").agg(F.avg("y").alias("y"))
    )
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def held_out(doc_id: Column) -> Column:
    """True for ids that no label is learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sum_before(
    df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str,
) -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` over earlier rows of the key by bucket and then
    order, and ``row``, the number in the bucket from 1.

    Buckets are summed first, so only the bucket sums of a key meet in one task, and rows are
    sorted bucket by bucket.
    """
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(starts.drop("_sum"), [*keys, bucket])
        .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(upto), F.lit(0)))
        .withColumn("row", F.row_number().over(inside)).drop("_start"))
