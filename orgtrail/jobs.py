"""The reports as runnable jobs: ``spark-submit orgtrail/jobs.py --help``.

Each job reads registry tables under one folder, builds its reports and writes them under
another. A report is one file only on request. The names of reports are fixed values.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orgtrail.functions.mandates import ADMINISTER, SHAREHOLDER
from orgtrail.operators.keys import require_companies, require_unique
from orgtrail.operators.sides import rest
from orgtrail.plans import owners, people, shared
from orgtrail.plans.dumps import CORE_TABLES, full_dump, full_dump_csv
from orgtrail.plans.portfolio import portfolio
from orgtrail.plans.representatives import representatives
from orgtrail.plans.sector import sector_financials
from orgtrail.schemas import REGISTRY
from orgtrail.session import label_jobs, scratch_released
from orgtrail.sources.keylists import key_in, read_vat_list, vat_list
from orgtrail.sources.sinks import DUMP_PARTITIONS, write_csv_named, write_csv_sorted, write_json
from orgtrail.sources.tables import scan_registry

#: Where registry tables are: a folder, or paths by table with a folder for the rest under "".
Where = str | dict[str, str]


def _write(reports: dict[str, DataFrame], out: str, single_file: bool) -> list[str]:
    return [
        write_csv_named(report, out, name, single_file=single_file) for name, report in reports.items()
    ]


def _companies(spark: SparkSession, registry: Where, checked: bool = True) -> DataFrame:
    """Companies; unless told otherwise, refused if a key stands for two of them."""
    orgs = scan_registry(spark, registry, "organisations")
    if checked:
        require_companies(orgs)
    return orgs


def _persons(spark: SparkSession, registry: Where, checked: bool = True) -> DataFrame:
    persons = scan_registry(spark, registry, "persons")
    if checked:
        require_unique(persons, "pid", "persons")
    return persons


def dump(
    spark: SparkSession,
    registry: Where,
    out: str,
    num_partitions: int = DUMP_PARTITIONS,
    kind: str = "parquet",
) -> list[str]:
    """The core tables, whole, as Parquet or as CSV in many files."""
    write = {"parquet": full_dump, "csv": full_dump_csv}[kind]
    written = []
    for name, (key, folder) in CORE_TABLES.items():
        written.append(f"{out.rstrip('/')}/{folder.removesuffix('parquet')}{kind}")
        write(scan_registry(spark, registry, name), key, written[-1], num_partitions)
    return written


def cross_border_reports(
    orgs: DataFrame, persons: DataFrame, cc: str, home: str
) -> dict[str, DataFrame]:
    """The reports of ``cross_border``, all from companies that are read and narrowed once."""
    homes = [home, ""]
    companies = rest(shared.cross_border_companies(orgs, home), "companies").frame
    return {
        f"{cc}Persons.csv": people.country_persons(persons, cc),
        f"{cc}AdministratorsWithCompanyData.csv": people.admins_at(persons, companies.filter("at_home"), cc),
        f"{cc}CompaniesOwnedBy{home}Companies.csv": owners.owner_pairs(companies, companies, homes, [cc]),
        f"{home}CompaniesOwnedBy{cc}Companies.csv": owners.owner_pairs(companies, companies, [cc], homes),
    }


def cross_border(
    spark: SparkSession,
    registry: Where,
    out: str,
    cc: str,
    home: str,
    single_file: bool = False,
    checked: bool = True,
) -> list[str]:
    """Persons of a country, the home companies they administer, ownership both ways."""
    with scratch_released(spark):
        tables = _companies(spark, registry, checked), _persons(spark, registry, checked)
        return _write(cross_border_reports(*tables, cc, home), out, single_file)


def country_reports(orgs: DataFrame, persons: DataFrame, cc: str, home: str) -> dict[str, DataFrame]:
    """The reports of ``country``, all from companies that are read and narrowed once."""
    wanted = [ADMINISTER, SHAREHOLDER]
    companies = rest(shared.linked_companies(orgs, cc, home), "companies").frame
    homes = companies.filter("at_home")
    there = companies.filter("there").withColumnRenamed("last_address_for_company", "last_address")
    return {
        f"{cc}Persons.csv": people.country_persons(persons, cc, people.FIELD),
        f"{cc}AdministratorsWithCompanyData.csv": people.country_mandates(
            persons, companies, cc, wanted, "mandate"
        ),
        f"{cc}CompaniesOwnedBy{home}Companies.csv": owners.links_between(homes, there),
        f"{home}CompaniesOwnedBy{cc}Companies.csv": owners.links_between(homes, there, owner="target"),
    }


def country(
    spark: SparkSession,
    registry: Where,
    out: str,
    cc: str,
    home: str,
    single_file: bool = False,
    checked: bool = True,
) -> list[str]:
    """Persons of a country with their companies, and participations both ways."""
    with scratch_released(spark):
        tables = _companies(spark, registry, checked), _persons(spark, registry, checked)
        return _write(country_reports(*tables, cc, home), out, single_file)


def ties_reports(
    orgs: DataFrame, persons: DataFrame, cc: str, categories, match: str = "org"
) -> dict[str, DataFrame]:
    """The reports of ``ties``, all from companies that are read and narrowed once."""
    companies = rest(shared.tied_companies(orgs, cc), "companies").frame
    there = companies.filter("there").select(*people.COMPANY_COLUMNS)
    return {
        f"{cc}Persons.csv": people.country_persons(persons, cc, people.LAST),
        f"{cc}Companies.csv": people.LAST.keep(there),
        f"{cc}AdministratorsWithCompanyData.csv": people.country_mandates(
            persons, companies, cc, categories, match, people.LAST
        ),
    }


def ties(
    spark: SparkSession,
    registry: Where,
    out: str,
    cc: str,
    categories,
    single_file: bool = False,
    match: str = "org",
    checked: bool = True,
) -> list[str]:
    """Persons and companies of a country, and the persons' mandates.

    ``match`` is ``org`` for all mandates of a company with a listed category, dated, or
    ``mandate`` for those of a listed category alone.
    """
    with scratch_released(spark):
        tables = _companies(spark, registry, checked), _persons(spark, registry, checked)
        return _write(ties_reports(*tables, cc, categories, match), out, single_file)


def sector(
    spark: SparkSession,
    registry: Where,
    out: str,
    prefix: str,
    year_from: int,
    year_to: int,
    single_file: bool = False,
    classification: str | None = None,
    checked: bool = True,
) -> list[str]:
    """Companies of a sector with their yearly financials, by company and year.

    One file, or sorted parts with a manifest that tells their order.
    """
    name = f"NACEBEL{prefix}_Financials_{year_from}_{year_to}.csv"
    with scratch_released(spark):
        orgs = _companies(spark, registry, checked)
        accounts = scan_registry(spark, registry, "annual_accounts")
        report = sector_financials(orgs, accounts, prefix, year_from, year_to, classification)
        if single_file:
            return [write_csv_named(report, out, name, single_file=True, ordered=True)]
        path = f"{out.rstrip('/')}/{name}"
        write_csv_sorted(report, path, ["vat", "year"])
        return [path]


def represent(
    spark: SparkSession,
    registry: Where,
    out: str,
    vats: DataFrame | list[str],
    variant: str = "file",
    single_file: bool = False,
    checked: bool = True,
) -> list[str]:
    """Representatives of the listed companies.

    Literal keys also go to the scan as a filter, where Parquet statistics can skip files.
    """
    with scratch_released(spark):
        orgs, persons = _companies(spark, registry, checked), _persons(spark, registry, checked)
        if isinstance(vats, list):
            orgs = orgs.filter(key_in(F.col("vat"), vats))
            vats = vat_list(spark, vats)
        report = representatives(orgs, persons, vats, variant)
        return _write({"VatList_With_Representatives.csv": report}, out, single_file)


def enrich_portfolio(
    spark: SparkSession,
    registry: Where,
    out: str,
    vats: DataFrame,
    created_at: datetime,
    single_file: bool = False,
    page_rows: int | None = None,
    checked: bool = True,
) -> list[str]:
    """The listed companies as nested documents, on request in pages of establishments."""
    with scratch_released(spark):
        orgs = _companies(spark, registry, checked)
        tables = [
            scan_registry(spark, registry, name) for name in ("annual_accounts", "establishments", "publications")
        ]
        write_json(portfolio(orgs, *tables, vats, created_at, page_rows), out, single_file)
        return [out]


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="orgtrail", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=about)
        sub.add_argument("--registry", default="", help="folder of the registry tables")
        sub.add_argument(
            "--path", action="append", default=[], metavar="TABLE=PATH", help="a table elsewhere; may be repeated"
        )
        sub.add_argument("--out", required=True)
        if name != "dump":
            sub.add_argument("--single-file", action="store_true")
            sub.add_argument("--unchecked", action="store_true", help="do not refuse repeated keys")
        return sub

    sub = job("dump", "core tables as Parquet or CSV")
    sub.add_argument("--partitions", type=int, default=DUMP_PARTITIONS)
    sub.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    for name in ("cross-border", "country", "ties"):
        sub = job(name, f"{name} reports of a country")
        sub.add_argument("--country", required=True)
        if name == "ties":
            sub.add_argument("--category", action="append")
            sub.add_argument("--match", choices=["org", "mandate"], default="org")
        else:
            sub.add_argument("--home", default="BE")
    sub = job("sector", "companies of a sector with financials")
    sub.add_argument("--prefix", required=True)
    sub.add_argument("--from", dest="year_from", type=int, required=True)
    sub.add_argument("--to", dest="year_to", type=int, required=True)
    sub.add_argument("--classification", help="only codes of this classification")
    sub = job("representatives", "representatives of listed companies")
    keys = sub.add_mutually_exclusive_group(required=True)
    keys.add_argument("--vats", help="CSV file of keys")
    keys.add_argument("--vat", action="append", help="a key; may be repeated")
    sub.add_argument("--variant", choices=["file", "list"], help="by default as the keys are given")
    sub = job("portfolio", "nested documents of listed companies")
    sub.add_argument("--vats", required=True)
    sub.add_argument("--page-rows", type=int, help="establishments of one document")
    return parser


def _where(registry: str, paths: list[str]) -> Where:
    found = dict(pair.partition("=")[::2] for pair in paths)
    odd = [name for name in found if name not in REGISTRY]
    if odd:
        raise ValueError(f"unknown tables {odd}; there are {list(REGISTRY)}")
    return {"": registry, **found} if found else registry


def main(arguments: list[str] | None = None) -> list[str]:
    args = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"orgtrail {args.job}").getOrCreate()
    label_jobs(spark, f"orgtrail {args.job}", f"{args.job} from {args.registry}")
    where = (spark, _where(args.registry, args.path), args.out)
    if args.job == "dump":
        return dump(*where, args.partitions, args.format)
    checked = not args.unchecked
    if args.job == "ties":
        categories = args.category or [ADMINISTER]
        return ties(*where, args.country.strip().upper(), categories, args.single_file, args.match, checked)
    if args.job in ("cross-border", "country"):
        run = country if args.job == "country" else cross_border
        return run(*where, args.country.strip().upper(), args.home, args.single_file, checked)
    if args.job == "sector":
        return sector(
            *where, args.prefix, args.year_from, args.year_to, args.single_file, args.classification, checked
        )
    if args.job == "representatives":
        if args.vat:
            return represent(*where, args.vat, args.variant or "list", args.single_file, checked)
        keys = read_vat_list(spark, args.vats)
        return represent(*where, keys, args.variant or "file", args.single_file, checked)
    keys = read_vat_list(spark, args.vats, column="vat")
    # The run's only clock reading; the documents all carry the same time.
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return enrich_portfolio(*where, keys, now, args.single_file, args.page_rows, checked)


if __name__ == "__main__":
    for path in main():
        print(path)
