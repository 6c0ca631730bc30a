"""Full dumps of the core tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgtrail.sources.sinks import DUMP_PARTITIONS, write_csv, write_parquet

# Core table, its key, its folder in a dump. A CSV dump ends in csv instead.
CORE_TABLES = {
    "organisations": ("vat", "organizations_parquet"),
    "persons": ("pid", "persons_parquet"),
    "annual_accounts": ("vat", "annual_accounts_parquet"),
}


def full_dump(df: DataFrame, key: str, path: str, num_partitions: int = DUMP_PARTITIONS) -> None:
    """Every row of ``df`` as Parquet, laid out by ``key``."""
    write_parquet(df, path, key, num_partitions)


def full_dump_csv(df: DataFrame, key: str, path: str, num_partitions: int = DUMP_PARTITIONS) -> None:
    """Every row of ``df`` as CSV in many files, laid out by ``key``; nested columns are JSON text."""
    flat = df.select(
        *[
            F.to_json(name).alias(name) if kind.startswith(("array", "struct", "map")) else F.col(name)
            for name, kind in df.dtypes
        ]
    )
    write_csv(flat.repartition(num_partitions, key), path)
