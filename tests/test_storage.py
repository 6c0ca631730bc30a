"""Sources, sinks, scratch folders and jobs."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.catalog import Registry
from orgtrail import jobs
from orgtrail import schemas as S
from orgtrail.operators.nested import flatten_profit_loss
from orgtrail.plans import owners, people
from orgtrail.plans.dumps import full_dump
from orgtrail.plans.portfolio import latest_accounts
from orgtrail.session import scratch_dir, scratch_released
from orgtrail.sources.keylists import read_vat_list, vat_list
from orgtrail.sources.sinks import read_manifest, write_csv, write_json, write_parquet
from orgtrail.sources.tables import scan, scan_registry
from tests import build as B


def data_files(path, kind):
    return sorted(path.rglob(f"part-*.{kind}"))


def key_file(tmp_path, text):
    path = tmp_path / "keys.csv"
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("header", ["VAT", "vat", "number"])
def test_key_list_headers(spark, tmp_path, header):
    path = key_file(tmp_path, f"{header};note\n A ;x\nB;\n  ;y\nA;z\n;w\n")
    assert sorted(row[0] for row in read_vat_list(spark, path).collect()) == ["A", "B"]


def test_key_column_is_found_behind_others_or_required(spark, tmp_path):
    path = key_file(tmp_path, "name;Vat\nx;A\n")
    assert [row[0] for row in read_vat_list(spark, path).collect()] == ["A"]
    with pytest.raises(ValueError, match="no column"):
        read_vat_list(spark, path, column="vat")
    comma = key_file(tmp_path, "vat,name\nA,x\n")
    assert [row[0] for row in read_vat_list(spark, comma, sep=",", column="vat").collect()] == ["A"]


def test_inline_keys(spark):
    assert sorted(row[0] for row in vat_list(spark, ["B", "A", "B"]).collect()) == ["A", "B"]
    assert vat_list(spark, []).collect() == []


def test_csv_null_and_empty_come_back_as_null(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a;b", 'say "x"'), (2, None, ""), (3, "é", "c")], "n int, s string, t string")
    path = tmp_path / "out"
    write_csv(rows.orderBy(F.desc("n")), str(path), single_file=True)
    (file,) = data_files(path, "csv")
    assert file.read_text(encoding="utf-8").splitlines() == ["n;s;t", "3;é;c", '2;;""', '1;"a;b";"say \\"x\\""']
    back = spark.read.option("header", True).option("sep", ";").csv(str(path)).collect()
    assert sorted(tuple(row) for row in back) == [("1", "a;b", 'say "x"'), ("2", None, None), ("3", "é", "c")]


def test_single_file_is_a_choice_at_any_size(spark, tmp_path):
    rows = spark.range(0, 100, 1, 4)
    write_csv(rows, str(tmp_path / "one"), single_file=True)
    write_csv(rows, str(tmp_path / "many"))
    write_json(rows, str(tmp_path / "json"), single_file=True)
    assert len(data_files(tmp_path / "one", "csv")) == 1
    assert len(data_files(tmp_path / "many", "csv")) == 4
    assert len(data_files(tmp_path / "json", "json")) == 1
    for name in ("one", "many"):
        assert spark.read.option("header", True).csv(str(tmp_path / name)).count() == 100


def test_dump_layouts_hold_all_rows_and_overwrite(spark, tmp_path):
    rows = spark.range(1000).withColumn("vat", (F.col("id") % 10).cast("string"))
    path = str(tmp_path / "dump")
    for _ in range(2):
        full_dump(rows, "vat", path, 8)
        assert spark.read.parquet(path).count() == 1000
    write_parquet(rows, path, "vat", 400, split_skew=False)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert back.count() == 1000
    assert back.select("vat", "file").distinct().count() == 10


def test_json_keeps_arrays_and_drops_nulls(spark, tmp_path):
    rows = B.persons(spark, {"pid": "P", "address_hists": [B.hist("2000-01-01", nl=B.address("BE"))]})
    write_json(rows, str(tmp_path / "out"), single_file=True)
    (file,) = data_files(tmp_path / "out", "json")
    assert file.read_text() == (
        '{"pid":"P","address_hists":[{"start_date":"2000-01-01","address_nl":{"country_code":"BE"}}]}\n'
    )
    assert spark.read.schema(S.PERSONS).json(str(tmp_path / "out")).collect() == rows.collect()


def test_strict_scan_names_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "persons")
    B.persons(spark, {"pid": "P"}).drop("last_name").withColumn("name", F.lit(1)).write.parquet(path)
    with pytest.raises(ValueError, match="last_name is missing; name is int, not string"):
        scan(spark, path, S.PERSONS)
    nested = str(tmp_path / "accounts")
    spark.sql("select 'A' vat, array(named_struct('period_end_date', date'2000-01-01')) summaries").write.parquet(nested)
    with pytest.raises(ValueError, match=r"summaries\[\].profit_loss is missing"):
        scan(spark, nested, S.ANNUAL_ACCOUNTS)
    extra = str(tmp_path / "extra")
    B.persons(spark, {"pid": "P"}).withColumn("more", F.lit(1)).write.parquet(extra)
    assert scan(spark, extra, S.PERSONS).schema.names == S.PERSONS.names
    lenient = scan(spark, path, StructType([S.PERSONS["pid"], S.PERSONS["last_name"]]), strict=False)
    assert [tuple(row) for row in lenient.collect()] == [("P", None)]


def test_scratch_folders_differ(spark):
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


@pytest.fixture(scope="module")
def registry(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("registry")
    r = Registry(spark, sf_dir)
    tables = {
        "organisations": r.orgs_with_mandates(),
        "persons": r.persons(),
        "annual_accounts": r.accounts(),
        "establishments": r.establishments(),
        "publications": r.publications(),
    }
    for name, df in tables.items():
        df.write.parquet(str(base / name))
    return str(base)


def csv_rows(spark, path):
    return spark.read.option("header", True).option("sep", ";").csv(path).count()


def test_country_jobs(spark, registry, tmp_path):
    for job, extra, reports in (
        ("cross-border", ["--country", "ir "], 4),
        ("country", ["--country", "CN", "--single-file"], 4),
        ("ties", ["--country", "CN", "--category", "ADMINISTER"], 3),
    ):
        out = str(tmp_path / job)
        written = jobs.main([job, "--registry", registry, "--out", out, *extra])
        assert len(written) == reports
    assert written[0].endswith("CNPersons.csv")


def csv_set(spark, path):
    rows = spark.read.option("header", True).option("sep", ";").csv(path)
    return rows.columns, sorted((tuple(row) for row in rows.collect()), key=repr)


def as_csv(spark, df, path):
    """What a report reads like once it was written."""
    write_csv(df, str(path))
    return csv_set(spark, str(path))


@pytest.fixture(scope="module")
def tables(spark, registry):
    return [scan_registry(spark, registry, name) for name in ("organisations", "persons")]


def test_jobs_write_what_the_plans_give(spark, registry, tables, tmp_path):
    """The narrow companies that a job's reports share give the same files as each plan by itself."""
    orgs, persons = tables
    wanted = {
        ("cross-border", "IR"): [
            people.country_persons(persons, "IR"),
            people.country_admins(persons, orgs, "IR", "BE"),
            owners.ownership(orgs, ["BE", ""], ["IR"]),
            owners.ownership(orgs, ["IR"], ["BE", ""]),
        ],
        ("country", "CN"): [
            people.country_persons(persons, "CN", people.FIELD),
            people.country_mandates(persons, orgs, "CN", ["ADMINISTER", "SHAREHOLDER"], "mandate"),
            owners.participation_links(orgs, "CN", "BE"),
            owners.participation_links(orgs, "CN", "BE", owner="target"),
        ],
        ("ties", "CN"): [
            people.country_persons(persons, "CN", people.LAST),
            people.country_companies(orgs, "CN"),
            people.country_mandates(persons, orgs, "CN", ["ADMINISTER"]),
        ],
    }
    filled = 0
    for (job, cc), reports in wanted.items():
        written = jobs.main([job, "--registry", registry, "--out", str(tmp_path / job), "--country", cc])
        for i, (path, report) in enumerate(zip(written, reports, strict=True)):
            found = csv_set(spark, path)
            assert found == as_csv(spark, report, tmp_path / f"{job}-{i}"), path
            filled += bool(found[1])
    assert filled >= 8


def test_reports_of_a_job_scan_the_companies_once(spark, registry, tables):
    orgs, persons = tables
    with scratch_released(spark):
        for reports in (
            jobs.cross_border_reports(orgs, persons, "IR", "BE"),
            jobs.country_reports(orgs, persons, "CN", "BE"),
            jobs.ties_reports(orgs, persons, "CN", ["ADMINISTER"]),
        ):
            for name, report in reports.items():
                assert not [path for path in report.inputFiles() if "/organisations/" in path], name
                report.count()


def test_jobs_leave_no_scratch(spark, registry, tmp_path):
    shared = Path(scratch_dir(spark, "x").removeprefix("file:")).parent
    before = set(shared.glob("*"))
    jobs.main(["ties", "--registry", registry, "--out", str(tmp_path / "out"), "--country", "CN"])
    assert set(shared.glob("*")) == before


def test_mandates_of_the_category_alone(spark, registry, tmp_path):
    common = ["ties", "--registry", registry, "--country", "CN", "--category", "ADMINISTER"]
    by_org = jobs.main([*common, "--out", str(tmp_path / "org")])[-1]
    by_mandate = jobs.main([*common, "--out", str(tmp_path / "mandate"), "--match", "mandate"])[-1]
    columns, rows = csv_set(spark, by_mandate)
    assert columns == people.PERSON_COLUMNS + people.COMPANY_COLUMNS
    listed = {row[:1] + row[4:5] for row in csv_set(spark, by_org)[1] if row[8] == "ADMINISTER"}
    assert rows and {row[:1] + row[4:5] for row in rows} == listed


def test_repeated_companies_are_refused_unless_unchecked(spark, registry, tables, tmp_path):
    orgs, _ = tables
    odd = str(tmp_path / "odd")
    orgs.unionByName(orgs.filter("vat = 'BE0000000004'").withColumn("name_fr", F.lit("other"))).write.parquet(odd)
    common = ["cross-border", "--registry", registry, "--path", f"organisations={odd}", "--country", "IR", "--out"]
    with pytest.raises(ValueError, match="1 repeated vat, such as 'BE0000000004'"):
        jobs.main([*common, str(tmp_path / "a")])
    assert len(jobs.main([*common, str(tmp_path / "b"), "--unchecked"])) == 4
    with pytest.raises(ValueError, match="unknown tables"):
        jobs.main(["dump", "--path", "companies=x", "--out", str(tmp_path / "c")])


def test_sector_job_in_sorted_parts(spark, registry, tmp_path):
    arguments = ["--prefix", "56", "--from", "1995", "--to", "2001"]
    (path,) = jobs.main(["sector", "--registry", registry, "--out", str(tmp_path / "many"), *arguments])
    (one,) = jobs.main(["sector", "--registry", registry, "--out", str(tmp_path / "one"), *arguments, "--single-file"])
    found = []
    for part in read_manifest(spark, path).collect():
        rows = spark.read.option("header", True).option("sep", ";").csv(f"{path}/part={part['part']}").collect()
        assert len(rows) == part["rows"] and rows[0]["vat"] == part["first"]["vat"] and rows[-1]["vat"] == part["last"]["vat"]
        found += [(row["vat"], row["year"]) for row in rows]
    wanted = spark.read.option("header", True).option("sep", ";").csv(one).select("vat", "year").collect()
    assert found == [tuple(row) for row in wanted] and found


def test_sector_job_is_one_sorted_file(spark, registry, tmp_path):
    arguments = ["--prefix", "56", "--from", "1997", "--to", "2001", "--single-file"]
    (path,) = jobs.main(["sector", "--registry", registry, "--out", str(tmp_path), *arguments])
    assert path.endswith("NACEBEL56_Financials_1997_2001.csv")
    (file,) = data_files(tmp_path, "csv")
    keys = [line.split(";")[0] for line in file.read_text().splitlines()[1:]]
    assert keys and keys == sorted(keys)


def test_representative_and_portfolio_jobs(spark, registry, tmp_path):
    keys = key_file(tmp_path, "vat\nBE0000000004\n BE0000000019 \n")
    common = ["--registry", registry, "--out"]
    (by_file,) = jobs.main(["representatives", *common, str(tmp_path / "a"), "--vats", keys])
    (by_key,) = jobs.main(["representatives", *common, str(tmp_path / "b"), "--vat", "BE0000000004"])
    assert csv_rows(spark, by_file) > csv_rows(spark, by_key) > 0
    (out,) = jobs.main(["portfolio", *common, str(tmp_path / "c"), "--vats", keys])
    documents = spark.read.json(out)
    assert sorted(row["vat"] for row in documents.collect()) == ["BE0000000004", "BE0000000019"]
    made = documents.select("export_metadata_created_at").distinct().collect()
    assert len(made) == 1 and datetime.fromisoformat(made[0][0])


def test_dump_job(spark, registry, tmp_path):
    written = jobs.main(["dump", "--registry", registry, "--out", str(tmp_path), "--partitions", "4"])
    sizes = [spark.read.parquet(path).count() for path in written]
    assert sizes == [150, 10, 150]


def test_dump_job_as_csv_in_many_files(spark, registry, tables, tmp_path):
    out = str(tmp_path / "csv")
    written = jobs.main(["dump", "--registry", registry, "--out", out, "--partitions", "3", "--format", "csv"])
    assert [path.rsplit("/", 1)[1] for path in written] == ["organizations_csv", "persons_csv", "annual_accounts_csv"]
    assert len(data_files(tmp_path / "csv" / "persons_csv", "csv")) > 1
    back = spark.read.option("header", True).option("sep", ";").option("escape", "\\").csv(written[1])
    hists = F.from_json("address_hists", S.PERSONS["address_hists"].dataType)
    got = back.select("pid", hists.alias("address_hists")).orderBy("pid").collect()
    assert got == tables[1].select("pid", "address_hists").orderBy("pid").collect()


def test_strict_scan_reads_the_footers_of_all_files(spark, tmp_path):
    path = str(tmp_path / "persons")
    B.persons(spark, {"pid": "P"}).coalesce(1).write.parquet(path)
    B.persons(spark, {"pid": "Q"}).withColumn("name", F.lit(1)).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match=r"part-00000-.*\.parquet: name is int, not string"):
        scan(spark, path, S.PERSONS)


def test_accounts_of_the_other_shape(spark, tmp_path):
    path = str(tmp_path / "annual_accounts")
    summary = {
        "period_end_date": datetime(2020, 12, 31).date(),
        "balance_sheet": {"gain_loss_period": {"current": 1.0, "previous": 9.0}, "turnover": {"current": 2.0}, "equity": None},
        "financial_analysis": {"ebitda": 3.0, "financial_health_indicator": 4.0},
        "employees": 5, "schema_type": "FULL", "currency": "EUR",
    }
    spark.createDataFrame([("A", [summary]), ("B", None)], S.ANNUAL_ACCOUNTS_BY_SHEET).write.parquet(path)
    found = scan_registry(spark, str(tmp_path), "annual_accounts")
    assert found.schema["summaries"].dataType.elementType == S.ACCOUNT_SUMMARY_BY_SHEET
    exported = {row["vat"]: row[1] for row in latest_accounts(found).collect()}
    assert exported["B"] == []
    assert exported["A"][0].asDict() == {
        "period_end_date": summary["period_end_date"], "turnover": 2.0, "profit": 1.0, "ebitda": 3.0,
        "equity": None, "land_buildings": None, "financial_health_indicator": 4.0,
    }
    (flat,) = flatten_profit_loss(found).collect()
    assert (flat["turnover"], flat["ebitda"], flat["operating_profit"], flat["profit_after_tax"]) == (2.0, 3.0, None, 1.0)
