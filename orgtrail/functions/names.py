"""Name and status fallbacks of companies and persons."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgtrail.functions.text import or_empty


def first_name_of(nl: Column, fr: Column, name: Column) -> Column:
    """Dutch, else French, else generic name, else ''; an empty name counts as a name."""
    return F.coalesce(nl, fr, name, F.lit(""))


def first_nonempty(nl: Column, fr: Column) -> Column:
    """The Dutch name if it is not empty, else the French one, else ''."""
    return F.coalesce(F.nullif(nl, F.lit("")), fr, F.lit(""))


def lookup_name(nl: Column, fr: Column, fallback: bool = False) -> Column:
    """The Dutch name or ''; the French one comes in only with ``fallback``."""
    return F.coalesce(nl, fr, F.lit("")) if fallback else or_empty(nl)


def rep_last_name(last: Column, name: Column) -> Column:
    """Last name, else the generic name, else ''."""
    return F.coalesce(last, name, F.lit(""))


def legal_status(form: Column, situation: Column) -> Column:
    """Juridical form, else juridical situation."""
    return F.coalesce(form, situation)
