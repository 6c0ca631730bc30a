"""A registry derived from the order tables, for trying the reports on given data.

Companies come from customers, persons from suppliers, mandates from order lines, yearly
accounts and establishments from orders and publications from events. Histories that hang on one source row are built in that row, without a
shuffle. Edge cases (missing names, padded codes, open and unordered histories, unknown
persons) follow from the keys.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from orgtrail.functions.addresses import last_hist
from orgtrail.operators.grouping import attach_sorted, distinct, task_parts
from orgtrail.operators.nested import MANDATE_COLUMNS
from orgtrail.schemas import ADDRESS, MANDATE, ORGANISATIONS

MANDATE_ORDER = ["start_date", "pid", "category", "role", "end_date"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vat(key: str) -> Column:
    return F.concat(F.lit("BE"), F.lpad(F.expr(key).cast("string"), 10, "0"))


def _country(number: str) -> Column:
    """A code by number: home, none, three countries, missing, padded, lower case, others."""
    return F.expr(
        f"if(({number}) % 25 < 8, get(array('BE', '', 'IR', 'CN', 'RU', null, ' ir ', 'cn'), "
        f"cast(({number}) % 25 as int)), concat('N', ({number}) % 25))"
    )


def _hist(i: int) -> Column:
    """History entry ``i`` from the columns that ``_with_hists`` has prepared."""

    def address(language: str) -> Column:
        parts = [
            F.col(f"{name}{i}" if name == "number" else name).alias(name)
            for name in ADDRESS.fieldNames()
            if name != "country_code"
        ]
        country = F.col(f"cc_{language}{i}").alias("country_code")
        return F.when(~F.col(f"no_{language}"), F.struct(*parts, country))

    return F.struct(
        F.col(f"start{i}").alias("start_date"),
        F.col(f"end{i}").alias("end_date"),
        address("nl").alias("address_nl"),
        address("fr").alias("address_fr"),
    )


def _with_hists(df: DataFrame, shared: dict[str, str], entry) -> DataFrame:
    """``df`` with ``hists``: two entries that share the ``shared`` expressions.

    ``entry(i)`` gives the expressions of entry ``i``: day number, whether it has a start
    and an end, house number, country numbers. Each is computed once per row, whichever of
    the two languages shows it.
    """
    prepared = {name: F.expr(text) for name, text in shared.items()}
    dates = {}
    for i in (0, 1):
        of = entry(i)
        prepared |= {
            f"days{i}": F.expr(of["days"]).cast("int"),
            f"number{i}": F.expr(of["number"]).cast("string"),
            f"cc_nl{i}": _country(of["nl"]),
            f"cc_fr{i}": _country(of["fr"]),
        }
        dates |= {
            f"start{i}": F.expr(f"if({of['no_start']}, null, date_add({of['from']}, days{i}))"),
            f"end{i}": F.expr(f"if({of['open']}, null, date_add({of['to']}, days{i}))"),
        }
    return df.withColumns(prepared).withColumns(dates).withColumn("hists", F.array(_hist(0), _hist(1)))


def _company_hists(customer: DataFrame) -> DataFrame:
    def entry(i: int) -> dict[str, str]:
        nation = f"c_nationkey + {1 - i} * (c_custkey % 4)"
        return {
            "days": f"(c_custkey * 37) % 15000 + if(c_custkey % 4 = 2, {1 - i}, {i}) * 1000",
            "from": "date'1960-01-01'",
            "to": "date'1962-01-01'",
            "no_start": "c_custkey % 17 = 0",
            "open": f"(c_custkey + {2 * i}) % 3 = 0 or c_custkey % 8 = 2",
            "number": f"c_custkey % 90 + {i}",
            "nl": nation,
            "fr": f"{nation} + if(c_custkey % 2 = 1, 1, 0)",
        }

    shared = {
        "no_nl": "c_custkey % 3 = 0 or c_custkey % 37 = 5",
        "no_fr": "c_custkey % 3 = 1 or c_custkey % 37 = 5",
        "street": "if(c_custkey % 19 = 0, '', concat('Street ', c_custkey % 200))",
        "box": "if(c_custkey % 5 = 0, 'b1', null)",
        "zip_code": "lpad(cast(c_custkey % 9999 as string), 4, '0')",
        "city": "concat('City ', c_nationkey)",
        "province": "if(c_custkey % 6 = 0, null, concat('Prov ', c_custkey % 6))",
    }
    return _with_hists(customer, shared, entry)


def _person_hists(supplier: DataFrame) -> DataFrame:
    def entry(i: int) -> dict[str, str]:
        nation = f"s_nationkey + {1 - i} * (s_suppkey % 4)"
        return {
            "days": f"(s_suppkey * 53) % 15000 + {i * 900}",
            "from": "date'1970-01-01'",
            "to": "date'1972-01-01'",
            "no_start": "false",
            "open": f"(s_suppkey + {i}) % 2 = 0",
            "number": f"s_suppkey % 70 + {i}",
            "nl": nation,
            "fr": nation,
        }

    shared = {
        "no_nl": "s_suppkey % 3 = 0",
        "no_fr": "s_suppkey % 3 = 1",
        "street": "concat('Lane ', s_suppkey)",
        "box": "cast(null as string)",
        "zip_code": "lpad(cast(s_suppkey % 9999 as string), 4, '0')",
        "city": "concat('Town ', s_nationkey)",
        "province": "cast(null as string)",
    }
    return _with_hists(supplier, shared, entry)


def _activity(i: int) -> Column:
    return F.expr(
        "named_struct('classification', case c_custkey % 5 when 0 then null when 1 then 'nacebel' "
        "when 2 then 'ISIC' else 'NACEBEL_2008' end, "
        f"'type_label', if((c_custkey + {i}) % 2 = 0, 'Primary', 'secondary'), "
        "'code', if(c_custkey % 29 = 0, null, concat(case c_mktsegment when 'HOUSEHOLD' then '56' "
        "when 'FURNITURE' then '31' when 'MACHINERY' then '28' when 'BUILDING' then '41' "
        f"else '45' end, 100 + (c_custkey + {i}) % 7)), "
        "'description_nl', if(c_custkey % 4 = 0, null, concat(c_mktsegment, ' nl')), "
        "'description_fr', concat(c_mktsegment, ' fr'))"
    )


def _participation(factor: int, offset: int, companies: Column) -> Column:
    related = (F.col("c_custkey") * factor + offset) % companies
    return F.struct(
        F.concat(F.lit("BE"), F.lpad(related.cast("string"), 10, "0")).alias("related_vat"),
        F.expr("if(c_custkey % 2 = 0, 'DIRECT', 'INDIRECT')").alias("interests_type"),
        F.expr("if(c_custkey % 5 = 0, null, cast(c_custkey % 100 as double))").alias("percentage"),
        F.lit(f"SRC{factor}").alias("source"),
    )


def _no_items(items: Column) -> Column:
    return F.slice(items, 1, 0)


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies; ``person_mandates`` is left empty."""
    customer = table(spark, sf_dir, "customer")
    hists = F.col("hists")
    activities = F.array(_activity(0), _activity(1), _activity(2))
    # The number of companies, as a subquery that is evaluated once.
    companies = customer.select(F.count("*")).scalar()
    held = F.sort_array(F.array(_participation(7, 1, companies), _participation(13, 5, companies)))
    key = F.col("c_custkey")
    orgs = _company_hists(customer).select(
        _vat("c_custkey").alias("vat"),
        F.expr(
            "case c_custkey % 7 when 0 then null when 1 then '' else concat(c_name, ' NV') end"
        ).alias("name_nl"),
        F.expr("if(c_custkey % 13 = 0, null, concat(c_name, ' SA'))").alias("name_fr"),
        F.expr("if(c_custkey % 3 = 0, c_name, null)").alias("name"),
        F.expr("if(c_custkey % 4 = 3, null, concat('FORM_', c_custkey % 4))").alias("juridical_form"),
        F.expr("concat('SIT_', c_custkey % 3)").alias("juridical_situation"),
        F.expr("date_add(date'1950-01-01', cast(c_custkey % 20000 as int))").alias("founding_date"),
        F.expr("if(c_custkey % 9 = 0, null, cast(c_custkey % 500 as int))").alias("employee_count"),
        F.expr("if(c_custkey % 10 = 0, null, c_acctbal)").alias("financial_health"),
        F.when(key % 100 == 0, F.lit(None))
        .when(key % 50 == 0, _no_items(hists))
        .otherwise(hists)
        .alias("address_hists"),
        F.when(key % 40 == 0, _no_items(activities))
        .otherwise(F.slice(activities, F.lit(1), (key % 3 + 1).cast("int")))
        .alias("activities"),
        F.array().cast(ArrayType(MANDATE)).alias("person_mandates"),
        F.when(F.col("c_acctbal") < 0, _no_items(held)).otherwise(held).alias("participation_hists"),
    )
    last = last_hist(F.col("address_hists"))
    orgs = orgs.withColumns({"address_nl": last["address_nl"], "address_fr": last["address_fr"]})
    return orgs.select(*ORGANISATIONS.fieldNames())


def with_mandates(orgs: DataFrame, flat: DataFrame, page_rows: int | None = None) -> DataFrame:
    """Companies with flat mandates folded into them; with ``page_rows`` one row per page.

    Whole arrays are gathered by as many tasks as the rows ask for, which ``flat`` is counted for.
    """
    if page_rows is None:
        parts = task_parts(flat.count())
        orgs, flat = orgs.repartition(parts, "vat"), flat.filter("vat is not null").repartition(parts, "vat")
    folded = attach_sorted(
        orgs.drop("person_mandates"), flat, "vat", MANDATE_ORDER, MANDATE_COLUMNS, "person_mandates", page_rows
    )
    return folded.select(*ORGANISATIONS.fieldNames())


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _person_hists(table(spark, sf_dir, "supplier")).select(
        F.expr("concat('P', s_suppkey)").alias("pid"),
        F.expr("if(s_suppkey % 8 = 0, null, concat('First', s_suppkey % 30))").alias("first_name"),
        F.expr("if(s_suppkey % 12 = 0, null, s_name)").alias("last_name"),
        F.col("s_name").alias("name"),
        F.expr("if(s_suppkey % 10 = 0, null, s_suppkey % 4 = 0)").alias("is_moral"),
        F.col("hists").alias("address_hists"),
    )


def mandates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat mandates: one row per company and the supplier of an order line.

    Lines meet their orders in as many tasks as there are lines for. Repeats go while a row is four numbers, which stand for the values of the mandate one to one;
    its text is made of them afterwards. ``shape`` numbers the kind of key, category, role, open
    end and function.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").filter("l_orderkey is not null")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").filter("o_orderkey is not null")
    parts = task_parts(lines.count())
    pairs = orders.repartition(parts, "o_orderkey").join(
        lines.repartition(parts, "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    both = "(o_custkey + l_suppkey)"
    kind = f"case when {both} % 23 = 0 then 0 when {both} % 29 = 0 then 1 else 2 end"
    category = f"case {both} % 3 when 0 then 0 when 1 then 1 else 2 end"
    role = f"case {both} % 4 when 0 then 0 when 1 then 1 when 2 then 2 else 3 end"
    is_open = f"if({both} % 2 = 0, 1, 0)"
    function = f"if({both} % 5 = 0, 0, coalesce({both} % 7 + 7, 0))"
    found = distinct(
        pairs.select(
            # A key of ten characters or more is shown by its first ten.
            F.expr("cast(left(cast(o_custkey as string), 10) as bigint)").alias("company"),
            F.expr(f"if({both} % 23 = 0, null, l_suppkey)").alias("person"),
            F.expr(f"cast((((({kind}) * 3 + {category}) * 4 + {role}) * 2 + {is_open}) * 14 + {function} as int)").alias("shape"),
            F.expr("cast((o_custkey * 7 + l_suppkey) % 7000 as int)").alias("days"),
        )
    )
    return found.select(
        _vat("company").alias("vat"),
        F.expr("case shape div 336 when 0 then null when 1 then concat('Q', person) else concat('P', person) end").alias("pid"),
        F.expr("case shape div 112 % 3 when 0 then 'ADMINISTER' when 1 then 'SHAREHOLDER' else 'AUDITOR' end").alias("category"),
        F.expr(
            "case shape div 28 % 4 when 0 then ' administrator' when 1 then 'Administer ' "
            "when 2 then 'Manager' else null end"
        ).alias("role"),
        F.expr("if(shape % 14 = 0, null, concat('Function ', shape % 14 - 7))").alias("function"),
        F.expr("date_add(date'2000-01-01', days)").alias("start_date"),
        F.expr("if(shape div 14 % 2 = 1, null, date_add(date'2003-01-01', days))").alias("end_date"),
    )


def annual_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly accounts; the array of a company is as long as its years."""
    cents = F.expr("sum(cast(round(o_totalprice * 100) as bigint))")
    yearly = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(cents.cast("double").alias("cents"), F.count("*").alias("n"))
    )
    n = F.col("n")
    summary = F.struct(
        F.make_date("year", F.lit(12), F.lit(31)).alias("period_end_date"),
        F.struct(
            F.round(F.col("cents") / 100, 2).alias("turnover"),
            F.when(n % 4 != 0, (n * 10).cast("double")).alias("ebitda"),
            (n * 7 - 20).cast("double").alias("operating_profit"),
            (n * 5 - 18).cast("double").alias("profit_after_tax"),
        ).alias("profit_loss"),
        F.struct(
            (n * 100).cast("double").alias("equity"),
            F.when(n % 3 != 0, (n * 50).cast("double")).alias("land_buildings"),
        ).alias("balance_sheet"),
        n.cast("int").alias("employees"),
        F.when(n % 2 == 0, "FULL").otherwise("ABBREVIATED").alias("schema_type"),
        F.lit("EUR").alias("currency"),
        F.when(n % 5 != 0, n * 2.5).alias("financial_health"),
    )
    return (
        yearly.groupBy("o_custkey")
        .agg(F.sort_array(F.collect_list(summary)).alias("summaries"))
        .select(_vat("o_custkey").alias("vat"), "summaries")
    )


def establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")

    def address(city: str, cities: int, absent: int) -> Column:
        parts = {
            "street": F.concat(F.lit("Quay "), key % 30),
            "city": F.concat(F.lit(f"{city} "), key % cities),
            "country_code": F.lit("BE"),
        }
        fields = [parts.get(name, F.lit(None).cast("string")).alias(name) for name in ADDRESS.fieldNames()]
        return F.when(key % absent != 0, F.struct(*fields))

    return table(spark, sf_dir, "orders").select(
        _vat("o_custkey").alias("vat"),
        F.col("o_orderkey").alias("est_id"),
        F.expr("concat('Est ', o_orderkey)").alias("name_nl"),
        F.expr("concat('Ets ', o_orderkey)").alias("name_fr"),
        F.expr("if(o_orderkey % 9 = 0, null, cast(o_orderdate as date))").alias("start_date"),
        F.expr("if(o_orderkey % 2 = 0, null, date_add(cast(o_orderdate as date), 400))").alias("end_date"),
        address("Stad", 50, 3).alias("address_nl"),
        address("Ville", 40, 4).alias("address_fr"),
        F.expr("if(o_orderkey % 5 = 0, null, concat('02 ', o_orderkey))").alias("telephone"),
        F.expr("if(o_orderkey % 6 = 0, null, concat('e', o_orderkey, '@example.org'))").alias("email"),
        F.expr("if(o_orderkey % 7 = 0, null, concat('https://example.org/', o_orderkey))").alias("website"),
        F.array(
            F.expr("case o_orderkey % 3 when 0 then ' 56101 ' when 1 then 'unknown activity' else '4711' end")
        ).alias("activities"),
    )


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications; each names one to three companies, the third repeating the first."""

    def company(user: str) -> Column:
        return F.struct(F.when(F.col("event_id") % 41 != 0, _vat(user)).alias("vat"))

    named = F.array(company("user_id"), company("user_id + 7"), company("user_id"))
    return table(spark, sf_dir, "events").select(
        F.expr("lpad(cast(event_id as string), 8, '0')").alias("publication_number"),
        F.col("ts").cast("date").alias("publication_date"),
        F.expr(
            "if(event_id % 5 = 0, null, concat('https://example.org/pub/', event_id, '.pdf'))"
        ).alias("pdf_link"),
        F.expr("if(event_id % 2 = 0, 'NL', 'FR')").alias("language"),
        F.when(F.col("event_id") % 6 != 0, F.array("event_type")).alias("subjects"),
        F.expr("if(event_id % 3 = 0, null, 'GAZETTE')").alias("source"),
        F.slice(named, F.lit(1), (F.col("event_id") % 3 + 1).cast("int")).alias("organizations"),
    )


def raw_vat_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key list as users hand it in: padded, with repeats, a blank and an unknown key."""
    listed = (
        table(spark, sf_dir, "customer")
        .filter((F.col("c_mktsegment") == "FURNITURE") & (F.col("c_acctbal") < 0))
        .withColumn("vat", _vat("c_custkey"))
    )
    padded = listed.select(F.concat(F.lit("  "), "vat", F.lit(" ")).alias("vat"))
    odd = spark.range(1).select(F.explode(F.array(F.lit("  "), F.lit("BE9999999999"))).alias("vat"))
    return padded.union(listed.filter(F.col("c_acctbal") < -500).select("vat")).union(odd)
