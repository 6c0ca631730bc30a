"""Flat relations over the given tables, as SQL for the oracles.

The Spark side nests its histories by other means (``orgtrail.sources.derived``); these
texts are written independently of it.
"""

import re


def _vat(key: str) -> str:
    return f"concat('BE', lpad(cast({key} as string), 10, '0'))"


def _country(n: str) -> str:
    return (
        f"case (({n}) % 25) when 0 then 'BE' when 1 then '' when 2 then 'IR' when 3 then 'CN' "
        "when 4 then 'RU' when 5 then null when 6 then ' ir ' when 7 then 'cn' "
        f"else concat('N', cast((({n}) % 25) as string)) end"
    )


_NATION = "c_nationkey + (1 - i) * (c_custkey % 4)"
_DAYS = (
    "cast((c_custkey * 37) % 15000 + case when c_custkey % 4 = 2 then 1 - i else i end * 1000 as int)"
)
_PERSON_NATION = "s_nationkey + (1 - i) * (s_suppkey % 4)"
_PERSON_DAYS = "cast((s_suppkey * 53) % 15000 + i * 900 as int)"
_BOTH = "(o_custkey + l_suppkey)"
_MANDATE_DAYS = "cast((o_custkey * 7 + l_suppkey) % 7000 as int)"

RECIPES = {
    "org": f"""
select c_custkey as k, {_vat('c_custkey')} as vat,
       case when c_custkey % 7 = 0 then null when c_custkey % 7 = 1 then '' else concat(c_name, ' NV') end as name_nl,
       case when c_custkey % 13 = 0 then null else concat(c_name, ' SA') end as name_fr,
       case when c_custkey % 3 = 0 then c_name else null end as name,
       case when c_custkey % 4 = 3 then null else concat('FORM_', cast(c_custkey % 4 as string)) end as juridical_form,
       concat('SIT_', cast(c_custkey % 3 as string)) as juridical_situation,
       date '1950-01-01' + cast(c_custkey % 20000 as int) as founding_date,
       case when c_custkey % 9 = 0 then null else cast(c_custkey % 500 as int) end as employee_count,
       case when c_custkey % 10 = 0 then null else c_acctbal end as financial_health
from customer""",
    "org_address": f"""
select {_vat('c_custkey')} as vat, i,
       case when c_custkey % 17 = 0 then null else date '1960-01-01' + {_DAYS} end as start_date,
       case when (c_custkey + i * 2) % 3 = 0 or c_custkey % 8 = 2 then null else date '1962-01-01' + {_DAYS} end as end_date,
       c_custkey % 3 = 0 or c_custkey % 37 = 5 as nl_null,
       c_custkey % 3 = 1 or c_custkey % 37 = 5 as fr_null,
       case when c_custkey % 19 = 0 then '' else concat('Street ', cast(c_custkey % 200 as string)) end as street,
       cast(c_custkey % 90 + i as string) as number,
       case when c_custkey % 5 = 0 then 'b1' else null end as box,
       lpad(cast(c_custkey % 9999 as string), 4, '0') as zip_code,
       concat('City ', cast(c_nationkey as string)) as city,
       case when c_custkey % 6 = 0 then null else concat('Prov ', cast(c_custkey % 6 as string)) end as province,
       {_country(_NATION)} as cc_nl,
       {_country(_NATION + ' + case when c_custkey % 2 = 1 then 1 else 0 end')} as cc_fr
from customer, (values (0), (1)) t(i)
where c_custkey % 50 <> 0""",
    "person": """
select concat('P', cast(s_suppkey as string)) as pid,
       case when s_suppkey % 8 = 0 then null else concat('First', cast(s_suppkey % 30 as string)) end as first_name,
       case when s_suppkey % 12 = 0 then null else s_name end as last_name,
       s_name as name,
       case when s_suppkey % 10 = 0 then null else s_suppkey % 4 = 0 end as is_moral
from supplier""",
    "person_address": f"""
select concat('P', cast(s_suppkey as string)) as pid, i,
       date '1970-01-01' + {_PERSON_DAYS} as start_date,
       case when (s_suppkey + i) % 2 = 0 then null else date '1972-01-01' + {_PERSON_DAYS} end as end_date,
       s_suppkey % 3 = 0 as nl_null, s_suppkey % 3 = 1 as fr_null,
       concat('Lane ', cast(s_suppkey as string)) as street,
       cast(s_suppkey % 70 + i as string) as number,
       cast(null as string) as box,
       lpad(cast(s_suppkey % 9999 as string), 4, '0') as zip_code,
       concat('Town ', cast(s_nationkey as string)) as city,
       cast(null as string) as province,
       {_country(_PERSON_NATION)} as cc_nl, {_country(_PERSON_NATION)} as cc_fr
from supplier, (values (0), (1)) t(i)""",
    "mandate": f"""
select distinct {_vat('o_custkey')} as vat,
       case when {_BOTH} % 23 = 0 then null when {_BOTH} % 29 = 0 then concat('Q', cast(l_suppkey as string)) else concat('P', cast(l_suppkey as string)) end as pid,
       case {_BOTH} % 3 when 0 then 'ADMINISTER' when 1 then 'SHAREHOLDER' else 'AUDITOR' end as category,
       case {_BOTH} % 4 when 0 then ' administrator' when 1 then 'Administer ' when 2 then 'Manager' else null end as role,
       case when {_BOTH} % 5 = 0 then null else concat('Function ', cast({_BOTH} % 7 as string)) end as "function",
       date '2000-01-01' + {_MANDATE_DAYS} as start_date,
       case when {_BOTH} % 2 = 0 then null else date '2003-01-01' + {_MANDATE_DAYS} end as end_date
from lineitem join orders on l_orderkey = o_orderkey""",
    "participation": f"""
select {_vat('c_custkey')} as vat,
       {_vat('((c_custkey * m + b) % (select count(*) from customer))')} as related_vat,
       case when c_custkey % 2 = 0 then 'DIRECT' else 'INDIRECT' end as interests_type,
       case when c_custkey % 5 = 0 then null else cast(c_custkey % 100 as double) end as percentage,
       concat('SRC', cast(m as string)) as source
from customer, (values (7, 1), (13, 5)) t(m, b)
where c_acctbal >= 0""",
    "activity": f"""
select {_vat('c_custkey')} as vat, i,
       case when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then 'nacebel' when c_custkey % 5 = 2 then 'ISIC' else 'NACEBEL_2008' end as classification,
       case when (c_custkey + i) % 2 = 0 then 'Primary' else 'secondary' end as type_label,
       case when c_custkey % 29 = 0 then null else concat(case c_mktsegment when 'HOUSEHOLD' then '56' when 'FURNITURE' then '31' when 'MACHINERY' then '28' when 'BUILDING' then '41' else '45' end, cast(100 + (c_custkey + i) % 7 as string)) end as code,
       case when c_custkey % 4 = 0 then null else concat(c_mktsegment, ' nl') end as description_nl,
       concat(c_mktsegment, ' fr') as description_fr
from customer, (values (0), (1), (2)) t(i)
where c_custkey % 40 <> 0 and i <= c_custkey % 3""",
    "annual_account": f"""
select {_vat('o_custkey')} as vat,
       cast(concat(cast(y as string), '-12-31') as date) as period_end_date,
       cast(y as int) as year,
       round(cents / 100, 2) as turnover,
       case when n % 4 = 0 then null else cast(n * 10 as double) end as ebitda,
       cast(n * 7 - 20 as double) as operating_profit,
       cast(n * 5 - 18 as double) as profit_after_tax,
       cast(n * 100 as double) as equity,
       case when n % 3 = 0 then null else cast(n * 50 as double) end as land_buildings,
       cast(n as int) as employees,
       case when n % 2 = 0 then 'FULL' else 'ABBREVIATED' end as schema_type,
       'EUR' as currency,
       case when n % 5 = 0 then null else cast(n * 2.5 as double) end as financial_health
from (select o_custkey, year(o_orderdate) as y, cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) as cents, count(*) as n
      from orders group by o_custkey, year(o_orderdate)) g""",
    "establishment": f"""
select {_vat('o_custkey')} as vat, o_orderkey as est_id,
       concat('Est ', cast(o_orderkey as string)) as name_nl,
       concat('Ets ', cast(o_orderkey as string)) as name_fr,
       case when o_orderkey % 9 = 0 then null else cast(o_orderdate as date) end as start_date,
       case when o_orderkey % 2 = 0 then null else cast(o_orderdate as date) + 400 end as end_date,
       case when o_orderkey % 3 = 0 then null else concat('Stad ', cast(o_orderkey % 50 as string)) end as city_nl,
       case when o_orderkey % 4 = 0 then null else concat('Ville ', cast(o_orderkey % 40 as string)) end as city_fr,
       case when o_orderkey % 3 = 0 and o_orderkey % 4 = 0 then null else concat('Quay ', cast(o_orderkey % 30 as string)) end as street,
       case when o_orderkey % 5 = 0 then null else concat('02 ', cast(o_orderkey as string)) end as telephone,
       case when o_orderkey % 6 = 0 then null else concat('e', cast(o_orderkey as string), '@example.org') end as email,
       case when o_orderkey % 7 = 0 then null else concat('https://example.org/', cast(o_orderkey as string)) end as website,
       case o_orderkey % 3 when 0 then ' 56101 ' when 1 then 'unknown activity' else '4711' end as activity
from orders""",
    "publication": """
select event_id, lpad(cast(event_id as string), 8, '0') as publication_number,
       cast(ts as date) as publication_date,
       case when event_id % 5 = 0 then null else concat('https://example.org/pub/', cast(event_id as string), '.pdf') end as pdf_link,
       case when event_id % 2 = 0 then 'NL' else 'FR' end as language,
       case when event_id % 6 = 0 then null else event_type end as subject,
       case when event_id % 3 = 0 then null else 'GAZETTE' end as source
from events""",
    "publication_org": f"""
select lpad(cast(event_id as string), 8, '0') as publication_number, j,
       case when event_id % 41 = 0 then null else {_vat('case when j = 2 then user_id else user_id + j * 7 end')} end as vat
from events, (values (0), (1), (2)) t(j)
where j <= event_id % 3""",
    "vat_list": f"""
select concat('  ', {_vat('c_custkey')}, ' ') as vat from customer where c_mktsegment = 'FURNITURE' and c_acctbal < 0
union all select {_vat('c_custkey')} from customer where c_mktsegment = 'FURNITURE' and c_acctbal < -500
union all select '  '
union all select 'BE9999999999'""",
    "keys": "select distinct trim(vat) as vat from vat_list where length(trim(vat)) > 0",
}


def _hist(table: str) -> str:
    return f"""
select *, not (nl_null and fr_null) as has_addr,
       case when not nl_null then cc_nl when not fr_null then cc_fr end as cc,
       coalesce(case when not nl_null then cc_nl end, case when not fr_null then cc_fr end, '') as cc_field
from {table}"""


def _first(table: str, key: str, order: str, where: str = "true") -> str:
    return f"""
select * from (select *, row_number() over (partition by {key} order by {order}) as rn
               from {table} where {where}) r where rn = 1"""


LATEST_ORDER = (
    "end_date is null desc, end_date desc nulls last, "
    "coalesce(start_date, date '1970-01-01') desc, i desc"
)

RECIPES |= {
    "org_hist": _hist("org_address"),
    "person_hist": _hist("person_address"),
    "org_latest": _first("org_hist", "vat", LATEST_ORDER),
    "person_latest": _first("person_hist", "pid", LATEST_ORDER),
    "org_current": _first("org_hist", "vat", "end_date is null desc, start_date desc nulls last, i desc"),
    "org_first_open": _first(
        "org_hist", "vat", "end_date is null desc, case when end_date is null then i end nulls last, i desc"
    ),
    "org_previous": _first("org_hist", "vat", "end_date desc, i desc", "end_date is not null"),
    "org_last_closed": _first("org_hist", "vat", "i desc", "end_date is not null"),
    "org_last": _first("org_hist", "vat", "i desc"),
    "person_last": _first("person_hist", "pid", "i desc"),
    "org_country": """
select vat, country from (
  select vat, upper(trim(cc_field)) as country, row_number() over (partition by vat order by i) as rn
  from org_hist where trim(cc_field) <> '') c where rn = 1""",
    "principal_strict": _first(
        "activity", "vat", "upper(type_label) = 'PRIMARY' desc, i",
        "upper(classification) in ('NACEBEL', 'NACEBEL_2008')",
    ),
    "principal_contains": _first(
        "activity", "vat", "i",
        "upper(classification) like '%NACE%' and upper(type_label) like '%PRIMARY%'",
    ),
    "ranked_publication": """
select *, row_number() over (partition by vat order by publication_date desc, publication_number desc) as latest
from (select distinct publication_number, vat from publication_org where vat is not null) o
join publication using (publication_number)""",
    "ranked_account": """
select *, row_number() over (partition by vat order by period_end_date desc) as latest
from annual_account""",
}


def with_recipes(sql: str) -> str:
    """The query with the relations it needs in front, those they need included."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = (words & RECIPES.keys()) - needed
        needed |= new
        pending += [RECIPES[name] for name in new]
    if not needed:
        return sql
    parts = ",\n".join(f"{name} as ({RECIPES[name].strip()})" for name in RECIPES if name in needed)
    return f"with {parts}\n{sql.strip()}"


def address_text(style: str, alias: str) -> str:
    """SQL for one address style over a history row."""
    a = alias

    def filled(*names: str) -> str:
        return ", ".join(f"nullif({a}.{name}, '')" for name in names)

    def trimmed(*names: str) -> str:
        return ", ".join(f"nullif(trim({a}.{name}), '')" for name in names)

    plain = ", ".join(f"{a}.{name}" for name in ("number", "street", "zip_code", "city", "province", "cc"))
    line = f"trim(concat_ws(' ', {filled('street', 'number', 'box')}))"
    text, missing = {
        "comma_trim": (f"concat_ws(',', {trimmed('street', 'number', 'zip_code', 'city', 'box', 'cc')})", "''"),
        "comma_nulls": (f"concat_ws(',', {plain})", "null"),
        "concat_ws": (f"concat_ws(',', {plain})", "''"),
        "comma_space": (f"concat_ws(', ', {filled('street', 'number', 'zip_code', 'city', 'cc')})", "''"),
        "line": (line, "''"),
        "full": (
            f"concat({line}, ', ', coalesce({a}.zip_code, ''), ' ', coalesce({a}.city, ''), ', ', coalesce({a}.cc, ''))",
            "''",
        ),
    }[style]
    return f"case when {a}.has_addr then {text} else {missing} end"


def address_part(field: str, alias: str) -> str:
    return f"coalesce(case when {alias}.has_addr then {alias}.{field} end, '')"
