"""Writing reports and dumps. Every sink overwrites its path."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Fixed value: parts of a dump.
DUMP_PARTITIONS = 400


def _keyed(df: DataFrame, key: str, n: int, split_skew: bool) -> DataFrame:
    return df.hint("rebalance", n, key) if split_skew else df.repartition(n, key)


def write_parquet(
    df: DataFrame, path: str, key: str, n: int = DUMP_PARTITIONS, split_skew: bool = False
) -> None:
    """Parquet in ``n`` hash parts by ``key``: all rows of a key are in one file.

    With ``split_skew`` adaptive execution may instead split the part of a hot key over
    several files and merge small parts.
    """
    _keyed(df, key, n, split_skew).write.mode("overwrite").parquet(path)


def _single(df: DataFrame, single_file: bool, ordered: bool) -> DataFrame:
    """One part if one is wanted.

    A sorted report keeps its order by ``coalesce``; any other is computed in parallel and
    only then brought together.
    """
    if not single_file:
        return df
    return df.coalesce(1) if ordered else df.repartition(1)


def _csv(writer):
    # The format of the reports.
    return (
        writer.option("header", True)
        .option("sep", ";")
        .option("encoding", "UTF-8")
        .option("nullValue", "")
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False, ordered: bool = False) -> None:
    """CSV in UTF-8 with a header and semicolons; null is written as nothing.

    ``single_file`` gives one file at any size, and one task writes it. Arrays and structs
    have no CSV form: write those as JSON.
    """
    _csv(_single(df, single_file, ordered).write.mode("overwrite")).csv(path)


MANIFEST = "_manifest"


def write_csv_sorted(df: DataFrame, path: str, order: list[str], parts: int | None = None) -> None:
    """CSV in ranges of ``order``, missing values first, each sorted, with a manifest of the ranges.

    Folders ``part=0`` and on follow each other in the order; the manifest says how many rows each
    has and from which to which. The order of the whole survives and no task writes it alone.
    Equal rows of ``order`` stay in one part. ``parts`` is the number of ranges at most.
    """
    ascending = [F.asc_nulls_first(name) for name in order]
    ranged = df.repartitionByRange(*([parts] if parts else []), *ascending).withColumn("part", F.spark_partition_id())
    _csv(ranged.sortWithinPartitions("part", *ascending).write.mode("overwrite").partitionBy("part")).csv(path)
    row = F.struct(*order)
    manifest = read_csv_sorted(df.sparkSession, path, df.schema).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min(row).alias("first"), F.max(row).alias("last")
    )
    # One row a part.
    manifest.coalesce(1).sortWithinPartitions("part").write.mode("overwrite").json(f"{path}/{MANIFEST}")


def read_csv_sorted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of ``write_csv_sorted`` with their ``part``, in no order."""
    rows = _csv(spark.read).schema(StructType([*schema.fields, StructField("part", IntegerType())]))
    return rows.csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The parts in order: ``part``, ``rows``, ``first`` and ``last`` values of the order."""
    return spark.read.json(f"{path}/{MANIFEST}").orderBy("part")


def write_csv_named(df: DataFrame, folder: str, name: str, **options) -> str:
    """CSV under a report name; returns the path."""
    path = f"{folder.rstrip('/')}/{name}"
    write_csv(df, path, **options)
    return path


def write_json(df: DataFrame, path: str, single_file: bool = False, ordered: bool = False) -> None:
    """JSON lines with nested arrays kept; a null field is left out."""
    _single(df, single_file, ordered).write.mode("overwrite").json(path)
