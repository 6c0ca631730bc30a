"""Which country an address, a history or a company belongs to."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgtrail.functions.text import strip


def addr(hist: Column) -> Column:
    """The Dutch address of a history entry, else the French one."""
    return F.coalesce(hist["address_nl"], hist["address_fr"])


def country_field(hist: Column) -> Column:
    """The Dutch country, else the French one, else ''.

    Unlike ``addr(hist).country_code`` this moves on to the French address when the
    Dutch one is present but has no country.
    """
    return F.coalesce(
        hist["address_nl"]["country_code"], hist["address_fr"]["country_code"], F.lit("")
    )


def norm_country(cc: Column) -> Column:
    """Trimmed upper-case code, '' for null."""
    return F.upper(strip(F.coalesce(cc, F.lit(""))))


def country_fields(hists: Column) -> Column:
    """``country_field`` of every entry.

    Works on the two arrays of codes rather than on entries, so that a scan reads only these.
    """
    return F.zip_with(
        hists["address_nl"]["country_code"],
        hists["address_fr"]["country_code"],
        lambda nl, fr: F.coalesce(nl, fr, F.lit("")),
    )


def country_codes(hists: Column) -> Column:
    """``addr(hist).country_code`` of every entry.

    Needs the Dutch address whole, to tell a missing one from one without a country, but
    only the code of the French one.
    """
    return F.zip_with(
        hists["address_nl"],
        hists["address_fr"]["country_code"],
        lambda nl, fr: F.when(nl.isNotNull(), nl["country_code"]).otherwise(fr),
    )


def any_country(
    hists: Column,
    cc: str,
    *,
    mode: str = "struct",
    trim: bool | None = None,
    empty_is_home: bool = False,
) -> Column:
    """Some history entry lies in country ``cc``.

    ``mode`` picks the country by address (``struct``) or by field (``field``). Codes are
    trimmed in struct mode unless ``trim`` says otherwise, and a blank one then names no
    country. With ``empty_is_home`` an entry without a country counts as well.
    """
    if mode not in ("struct", "field"):
        raise ValueError(f"unknown mode {mode!r}")
    trim = mode == "struct" if trim is None else trim
    wanted = {cc.strip().upper()}
    if mode == "struct" and trim:
        wanted -= {""}
    if empty_is_home:
        wanted |= {""}

    def is_wanted(code: Column) -> Column:
        code = F.coalesce(code, F.lit("")) if empty_is_home else code
        return F.coalesce(F.upper(strip(code) if trim else code).isin(list(wanted)), F.lit(False))

    return F.exists(country_fields(hists) if mode == "field" else country_codes(hists), is_wanted)


def first_country(hists: Column) -> Column:
    """The first non-empty country of a history, null if there is none."""
    codes = F.transform(country_fields(hists), lambda code: F.upper(F.trim(code)))
    return F.get(F.filter(codes, lambda code: code != ""), F.lit(0))


def country_in(cc: Column, values) -> Column:
    """Scalar country membership, codes as typed; a null country never matches."""
    return cc.isin(sorted({value.strip().upper() for value in values}))
