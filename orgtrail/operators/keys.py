"""Whether a key is unique: an input check of tables that reports join by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgtrail.operators.sides import rest

#: Keys that an error names.
SHOWN = 5


def repeated_keys(df: DataFrame, key: str, alike: list[str] | None = None) -> DataFrame:
    """Keys that stand in several rows: (key, rows, variants).

    With ``alike``, only those whose rows differ in one of these columns: rows that agree in all
    of them are pages of one record. ``variants`` counts the different rows, 1 without ``alike``.
    Null keys belong to no record and are left out.

    One pass over the key column sends 8 bytes of hash a row, counted in each task first, and keeps
    the hashes seen twice. Where there are none, which is the rule, that is all. Else the
    rows of those suspects alone are read again and counted exactly, so equal hashes of
    different keys report nothing.
    """
    keyed = df.filter(F.col(key).isNotNull())
    hashes = keyed.select(F.xxhash64(key).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    suspects = rest(hashes.filter("n > 1").select("_hash"), "suspects")
    row = F.xxhash64(*alike) if alike else F.lit(0)
    few = keyed.select(key, row.cast("long").alias("_row"), F.xxhash64(key).alias("_hash"))
    # Without suspects the join is empty, and the optimiser drops the second scan.
    few = few.join(suspects.hinted(), "_hash", "left_semi") if suspects.rows else few.limit(0)
    counted = few.groupBy(key, "_row").agg(F.count(F.lit(1)).alias("n"))
    found = counted.groupBy(key).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).cast("int").alias("variants"))
    return found.filter("variants > 1" if alike else "rows > 1")


def require_unique(df: DataFrame, key: str, what: str, alike: list[str] | None = None) -> None:
    """Refuse a table whose key repeats, naming some of the keys."""
    found = rest(repeated_keys(df, key, alike), "repeated")
    if found.rows:
        shown = [row[0] for row in found.frame.orderBy(F.desc("rows"), key).limit(SHOWN).collect()]
        raise ValueError(f"{what}: {found.rows} repeated {key}, such as {', '.join(map(repr, shown))}")


def require_companies(orgs: DataFrame) -> None:
    """Companies may take several rows only as pages: rows that differ in their mandates alone."""
    require_unique(orgs, "vat", "organisations", [name for name in orgs.columns if name not in ("vat", "person_mandates")])
