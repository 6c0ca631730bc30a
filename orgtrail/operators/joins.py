"""Equi-joins between persons, mandates, companies and their records.

Sides that may be small are written at rest and measured once (``operators.sides``): below the
bound they are broadcast, beyond it the other table is cut by a bitmap of their keys first. Where
many rows meet a single one, keys that outweigh a task are found by a bounded summary and dealt to
several tasks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgtrail.functions.countries import any_country
from orgtrail.operators.sides import Side, as_side, maybe_listed, rest

#: Keys over which rows without a person are spread.
NOBODY = 1024
#: Keys that a summary keeps, the entries it counts them with, and the parts of a heavy key.
HEAVY_KEYS, SUMMARY_ENTRIES, MOST_SALTS = 1000, 20_000, 256


def sized_join(left: DataFrame, right: DataFrame | Side, key: str) -> DataFrame:
    """Inner join that broadcasts the right side if it is small; the left is never measured."""
    side = as_side(right, "side")
    if side.fits():
        return left.join(F.broadcast(side.frame), key)
    return maybe_listed(left, side, key).join(side.frame, key)


def restrict(df: DataFrame, vats: DataFrame | Side, key: str = "vat", keep: str = "semi") -> DataFrame:
    """The rows whose key is listed.

    ``keep="join"`` joins instead of testing, for a list that carries columns of its own. A list
    beyond the bound cuts ``df`` by its bitmap where ``df`` is read; the join decides behind it. A
    list that cuts several tables should be put at rest by the caller, once.
    """
    how = {"semi": "left_semi", "join": "inner"}[keep]
    side = as_side(vats, "keys")
    if side.fits():
        return df.join(F.broadcast(side.frame), key, how)
    return maybe_listed(df, side, key).join(side.frame, key, how)


def restrict_home(df: DataFrame, orgs: DataFrame, home: str) -> DataFrame:
    """The rows whose company has an address in the home country."""
    at_home = orgs.filter(any_country(F.col("address_hists"), home)).select("vat")
    return df.join(at_home, "vat", "left_semi")


def heavy_keys(df: DataFrame, key: str, parts: int | None = None) -> dict:
    """Keys with more rows than an even one of ``parts`` tasks, and how many such tasks they fill.

    One aggregation whose summaries are of fixed size and merge; a key that it misses or
    overcounts costs balance, not rows.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(F.col(key).alias("k")).filter("k is not null")
    found = keys.agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {HEAVY_KEYS}, {SUMMARY_ENTRIES})").alias("top")
    ).first()
    even = found["n"] / parts
    fills = {row["item"]: math.ceil(row["count"] / max(even, 1)) for row in found["top"] or []}
    return {k: min(n, MOST_SALTS) for k, n in fills.items() if n > 1}


def _by_key(key: Column, values: dict) -> Column:
    """The value of a listed key, 1 for any other."""
    if not values:
        return F.lit(1)
    listed = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(listed[key], F.lit(1))


def spread_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner", heavy: dict | None = None) -> DataFrame:
    """``many`` beside the rows of ``one``, with the rows of heavy keys dealt to several tasks.

    A heavy key's rows of ``many`` take turns in salts, and its rows of ``one`` are copied to each
    of them. Other keys go as they are. ``how`` is ``inner`` or ``left``.
    """
    heavy = heavy_keys(many, key) if heavy is None else heavy
    if not heavy:
        return many.join(one, key, how)
    turn = F.pmod(F.monotonically_increasing_id(), _by_key(F.col(key), heavy)).cast("int")
    salts = F.sequence(F.lit(0), _by_key(F.col(key), heavy) - 1)
    salted = many.withColumn("_salt", turn)
    return salted.join(one.withColumn("_salt", F.explode(salts)), [key, "_salt"], how).drop("_salt")


def join_mandates(persons: DataFrame | Side, mandates: DataFrame) -> DataFrame:
    """Persons beside the mandates that name them; a person may hold any share of the mandates."""
    if isinstance(persons, Side) and persons.fits():
        return F.broadcast(persons.frame).join(mandates, "pid")
    if isinstance(persons, Side):
        mandates, persons = rest(maybe_listed(mandates, persons, "pid"), "mandates").frame, persons.frame
    own = [name for name in mandates.columns if name != "pid"]
    return spread_join(mandates, persons, "pid").select(*persons.columns, *own)


def add_person_names(mandates: DataFrame, persons: DataFrame | Side) -> DataFrame:
    """Person columns beside each mandate; a mandate of an unknown person stays.

    Mandates without a person match nobody. They go by keys that no person has, since by
    their null all of them would meet in one task.
    """
    if isinstance(persons, Side) and persons.fits():
        return mandates.join(F.broadcast(persons.frame), "pid", "left").select(
            *mandates.columns, *[name for name in persons.frame.columns if name != "pid"]
        )
    persons = persons.frame if isinstance(persons, Side) else persons
    heavy = heavy_keys(mandates, "pid")
    spread = F.pmod(F.xxhash64(*mandates.columns), F.lit(NOBODY)).cast("string")
    keyed = mandates.withColumn(
        "join_pid", F.coalesce(F.col("pid"), F.concat(F.lit("\x00"), spread))
    )
    named = persons.withColumnRenamed("pid", "join_pid")
    return spread_join(keyed, named, "join_pid", "left", heavy).drop("join_pid")


def add_financials(orgs: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account rows beside each company; a company without accounts keeps one row.

    Filter the accounts before: afterwards the filter would drop those companies.
    """
    return orgs.join(accounts, "vat", "left")


def enrich(orgs: DataFrame, *grouped: DataFrame) -> DataFrame:
    """Left joins of one-row-per-company tables onto the companies."""
    return reduce(lambda left, right: left.join(right, "vat", "left"), grouped, orgs)


def participation_join(parts: DataFrame, owned: DataFrame | Side, key: str = "vat") -> DataFrame:
    """Participations beside the company they are held in."""
    return sized_join(parts, owned, key)


def ownership_pairs(parts: DataFrame, lookup: DataFrame) -> DataFrame:
    """(owner, owned) rows from (vat, related_vat) and a lookup of (vat, name, country)."""
    owners = lookup.select(
        "vat", F.col("name").alias("owner_name"), F.col("country").alias("owner_country")
    )
    owned = lookup.select(
        F.col("vat").alias("related_vat"),
        F.col("name").alias("owned_name"),
        F.col("country").alias("owned_country"),
    )
    return (
        parts.join(owners, "vat")
        .join(owned, "related_vat")
        .select(
            F.col("vat").alias("owner_vat"),
            "owner_name",
            "owner_country",
            F.col("related_vat").alias("owned_vat"),
            "owned_name",
            "owned_country",
        )
    )
