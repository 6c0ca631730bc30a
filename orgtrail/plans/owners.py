"""Who owns whom across a border."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.countries import any_country, country_in, first_country
from orgtrail.functions.names import lookup_name
from orgtrail.operators.joins import participation_join, sized_join
from orgtrail.operators.nested import flatten_participation
from orgtrail.plans.people import FIELD


def ownership_lookup(orgs: DataFrame, fallback: bool = False) -> DataFrame:
    """Company, shown name and first non-empty country of its history."""
    return orgs.select(
        "vat",
        lookup_name(F.col("name_nl"), F.col("name_fr"), fallback).alias("name"),
        first_country(F.col("address_hists")).alias("country"),
    )


def ownership(orgs: DataFrame, owner_cc, owned_cc, fallback: bool = False) -> DataFrame:
    """(owner, owned) pairs with the owner in one set of countries and the owned in another."""
    lookup = ownership_lookup(orgs, fallback)
    companies = orgs.select(
        "vat",
        lookup_name(F.col("name_nl"), F.col("name_fr"), fallback).alias("name"),
        first_country(F.col("address_hists")).alias("country"),
        "participation_hists",
    )
    return owner_pairs(companies, lookup, owner_cc, owned_cc)


def owner_pairs(companies: DataFrame, lookup: DataFrame, owner_cc, owned_cc) -> DataFrame:
    """``ownership`` from companies with name, country and participations, and a lookup without these.

    The owner's name and country come along with its own participations, so that only the
    owned company is looked up. Both sides are cut to their countries before the join.
    """
    owners = companies.select(
        F.col("vat").alias("owner_vat"),
        F.col("name").alias("owner_name"),
        F.col("country").alias("owner_country"),
        "participation_hists",
    ).filter(country_in(F.col("owner_country"), owner_cc))
    owned = lookup.select(
        F.col("vat").alias("related_vat"), F.col("name").alias("owned_name"), F.col("country").alias("owned_country")
    ).filter(country_in(F.col("owned_country"), owned_cc))
    parts = flatten_participation(owners).select("owner_vat", "owner_name", "owner_country", "related_vat")
    return sized_join(parts, owned, "related_vat").select(
        "owner_vat",
        "owner_name",
        "owner_country",
        F.col("related_vat").alias("owned_vat"),
        "owned_name",
        "owned_country",
    )


def at_home(home: str) -> Column:
    """Some address at home, or without a country."""
    return any_country(F.col("address_hists"), home, mode="field", empty_is_home=True)


def participation_links(orgs: DataFrame, cc: str, home: str, owner: str = "home") -> DataFrame:
    """Participations between home companies and companies of ``cc``.

    ``owner`` says which side holds them: ``home`` or ``target``. The company of ``cc``
    shows its last address.
    """
    names = ["vat", "name_nl", "name_fr", "participation_hists"]
    homes = orgs.filter(at_home(home)).select(*names)
    targets = orgs.filter(FIELD.matches(cc)).select(*names, "address_hists")
    return links_between(homes, FIELD.with_text(targets, "last_address"), owner)


def links_between(homes: DataFrame, targets: DataFrame, owner: str = "home") -> DataFrame:
    """``participation_links`` between given companies; targets have their ``last_address``."""
    if owner not in ("home", "target"):
        raise ValueError(f"unknown owner {owner!r}")
    homes = homes.select(
        F.col("vat").alias("vat_home"),
        F.col("name_nl").alias("name_nl_home"),
        F.col("name_fr").alias("name_fr_home"),
        "participation_hists",
    )
    targets = targets.select("vat", "name_nl", "name_fr", "last_address", "participation_hists")
    holders, held, key = (homes, targets, "vat") if owner == "home" else (targets, homes, "vat_home")
    parts = flatten_participation(holders).withColumnRenamed("related_vat", key)
    return participation_join(parts, held.drop("participation_hists"), key).select(
        "vat_home",
        "name_nl_home",
        "name_fr_home",
        "vat",
        "name_nl",
        "name_fr",
        "last_address",
        F.col("interests_type").alias("type"),
        "percentage",
        "source",
    )
