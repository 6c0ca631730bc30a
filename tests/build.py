"""Hand-made registry rows."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from orgtrail import schemas as S


def address(country=None, **parts):
    fields = dict.fromkeys(S.ADDRESS.fieldNames())
    return {**fields, "country_code": country, **parts}


def hist(start=None, end=None, nl=None, fr=None):
    def day(text):
        return None if text is None else date.fromisoformat(text)

    return {"start_date": day(start), "end_date": day(end), "address_nl": nl, "address_fr": fr}


def mandate(pid, category=None, role=None, start=None, end=None):
    def day(text):
        return None if text is None else date.fromisoformat(text)

    return {
        "pid": pid,
        "category": category,
        "role": role,
        "function": None,
        "start_date": day(start),
        "end_date": day(end),
    }


def _rows(spark: SparkSession, schema, rows) -> DataFrame:
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], schema)


def orgs(spark: SparkSession, *rows) -> DataFrame:
    empty = {"address_hists": [], "activities": [], "person_mandates": [], "participation_hists": []}
    return _rows(spark, S.ORGANISATIONS, [{**empty, **row} for row in rows])


def persons(spark: SparkSession, *rows) -> DataFrame:
    return _rows(spark, S.PERSONS, [{"address_hists": [], **row} for row in rows])


def accounts(spark: SparkSession, *rows) -> DataFrame:
    return _rows(spark, S.ANNUAL_ACCOUNTS, rows)


def establishments(spark: SparkSession, *rows) -> DataFrame:
    return _rows(spark, S.ESTABLISHMENTS, rows)


def publications(spark: SparkSession, *rows) -> DataFrame:
    return _rows(spark, S.PUBLICATIONS, rows)
