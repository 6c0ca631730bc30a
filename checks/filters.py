"""Predicates."""

from pyspark.sql import functions as F

from checks.catalog import HOME, OTHER, SECTOR, TARGET, Registry, hists, query
from orgtrail.functions.activities import has_activity_prefix
from orgtrail.functions.countries import any_country, country_in
from orgtrail.functions.mandates import ADMINISTER, SHAREHOLDER, category_in, has_category, nonempty, role_in
from orgtrail.functions.records import year_between
from orgtrail.functions.text import nonblank
from orgtrail.operators.nested import flatten_mandate, flatten_profit_loss
from orgtrail.plans.owners import ownership_lookup
from orgtrail.sources.keylists import key_in

LISTED = ("BE0000000004", "BE0000000019", "BE9999999999")


@query("filter_any_address_country", f"select distinct vat from org_hist where upper(trim(cc)) = '{TARGET}'")
def any_address_country(r: Registry):
    return r.orgs().filter(any_country(hists(), TARGET)).select("vat")


@query("filter_any_address_country_ci", f"select distinct vat from org_hist where upper(cc) = '{OTHER}'")
def any_address_country_ci(r: Registry):
    return r.orgs().filter(any_country(hists(), OTHER, trim=False)).select("vat")


@query("filter_any_address_country_field", f"select distinct vat from org_hist where upper(cc_field) = '{OTHER}'")
def any_address_country_field(r: Registry):
    return r.orgs().filter(any_country(hists(), OTHER, mode="field")).select("vat")


@query("filter_home_strict", f"select distinct vat from org_hist where upper(trim(cc)) = '{HOME}'")
def home_strict(r: Registry):
    return r.orgs().filter(any_country(hists(), HOME)).select("vat")


@query("filter_home_or_empty", f"select distinct vat from org_hist where upper(cc_field) in ('{HOME}', '')")
def home_or_empty(r: Registry):
    return r.orgs().filter(any_country(hists(), HOME, mode="field", empty_is_home=True)).select("vat")


@query(
    "filter_role_set",
    "select vat, pid, category, role, cast(start_date as string) as start_date from mandate "
    "where upper(trim(role)) in ('ADMINISTER', 'ADMINISTRATOR')",
)
def role_set(r: Registry):
    kept = r.mandates().filter(role_in(F.col("role")))
    return kept.select("vat", "pid", "category", "role", "start_date")


@query(
    "filter_mandate_category",
    "select vat, pid, category, role, cast(start_date as string) as start_date from mandate "
    "where category in ('ADMINISTER', 'SHAREHOLDER')",
)
def mandate_category(r: Registry):
    kept = flatten_mandate(r.orgs_with_mandates().select("vat", "person_mandates")).filter(
        category_in(F.col("category"), [ADMINISTER, SHAREHOLDER])
    )
    return kept.select("vat", "pid", "category", "role", "start_date")


@query("filter_org_has_category", "select distinct vat from mandate where category = 'ADMINISTER'")
def org_has_category(r: Registry):
    orgs = r.orgs_with_mandates().filter(has_category(F.col("person_mandates"), [ADMINISTER]))
    return orgs.select("vat").distinct()


@query("filter_nonempty_array", "select distinct vat from mandate")
def nonempty_array(r: Registry):
    return r.orgs_with_mandates().filter(nonempty(F.col("person_mandates"))).select("vat").distinct()


@query("filter_year_between", "select vat, year, turnover from annual_account where year between 1997 and 1999")
def years(r: Registry):
    accounts = flatten_profit_loss(r.accounts())
    return accounts.filter(year_between(F.col("period_end_date"), 1997, 1999)).select("vat", "year", "turnover")


@query("filter_activity_prefix", f"select distinct vat from activity where code like '{SECTOR}%'")
def activity_prefix(r: Registry):
    return r.orgs().filter(has_activity_prefix(F.col("activities"), SECTOR)).select("vat")


@query("filter_blank_keys", "select vat from vat_list where length(trim(vat)) > 0")
def blank_keys(r: Registry):
    return r.raw_keys().filter(nonblank(F.col("vat")))


@query("filter_key_in_list", f"select vat, name_fr from org where vat in {LISTED}")
def key_in_list(r: Registry):
    return r.orgs().filter(key_in(F.col("vat"), LISTED)).select("vat", "name_fr")


@query("filter_country_membership", f"select vat, country from org_country where country in ('{HOME}', '{TARGET}')")
def country_membership(r: Registry):
    lookup = ownership_lookup(r.orgs()).select("vat", "country")
    return lookup.filter(country_in(F.col("country"), [HOME, TARGET]))
