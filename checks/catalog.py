"""The register that the query modules fill."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.recipes import with_recipes
from orgtrail import schemas as S
from orgtrail.session import scratch_dir
from orgtrail.sources import derived
from orgtrail.sources.keylists import clean_keys
from orgtrail.sources.tables import scan

HOME = "BE"
TARGET = "IR"
OTHER = "CN"
SECTOR = "56"
YEARS = (1997, 2001)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


WRITTEN: dict[tuple[str, str, str], str] = {}


@dataclass(frozen=True)
class Registry:
    """The registry of one data folder, as Parquet at rest.

    A table is derived from the given ones and written to the session's shared folder when
    a query first asks for it; all queries of the session then scan what was written, with
    their own columns and filters pushed down.
    """

    spark: SparkSession
    sf_dir: str

    def _at_rest(self, name: str, schema: StructType, derive: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key in WRITTEN:
            try:
                return scan(self.spark, WRITTEN[key], schema, strict=False)
            except AnalysisException:  # the folder was cleared in between
                del WRITTEN[key]
        path = scratch_dir(self.spark, name)
        derive().write.parquet(path)
        WRITTEN[key] = path
        return scan(self.spark, path, schema, strict=False)

    def orgs(self) -> DataFrame:
        return self._at_rest(
            "organisations", S.ORGANISATIONS, lambda: derived.organisations(self.spark, self.sf_dir)
        )

    def orgs_with_mandates(self) -> DataFrame:
        return self._at_rest(
            "organisations_with_mandates",
            S.ORGANISATIONS,
            lambda: derived.with_mandates(self.orgs(), self.mandates()),
        )

    def persons(self) -> DataFrame:
        return self._at_rest("persons", S.PERSONS, lambda: derived.persons(self.spark, self.sf_dir))

    def mandates(self) -> DataFrame:
        return self._at_rest(
            "mandates", S.MANDATES, lambda: derived.mandates(self.spark, self.sf_dir)
        )

    def accounts(self) -> DataFrame:
        return self._at_rest(
            "annual_accounts", S.ANNUAL_ACCOUNTS, lambda: derived.annual_accounts(self.spark, self.sf_dir)
        )

    def establishments(self) -> DataFrame:
        return self._at_rest(
            "establishments", S.ESTABLISHMENTS, lambda: derived.establishments(self.spark, self.sf_dir)
        )

    def publications(self) -> DataFrame:
        return self._at_rest(
            "publications", S.PUBLICATIONS, lambda: derived.publications(self.spark, self.sf_dir)
        )

    def raw_keys(self) -> DataFrame:
        return self._at_rest(
            "vat_list", S.VAT_LIST, lambda: derived.raw_vat_list(self.spark, self.sf_dir)
        )

    def keys(self) -> DataFrame:
        return clean_keys(self.raw_keys(), "vat")


def hists() -> Column:
    return F.col("address_hists")


def comparable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, which both engines write alike."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("string").alias(name) if kind in ("date", "timestamp") else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def query(name: str, sql: str):
    """Register a function of a Registry, and its oracle."""

    def register(build: Callable[[Registry], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: comparable(build(Registry(spark, sf_dir)))
        ORACLES[name] = with_recipes(sql)
        return build

    return register
