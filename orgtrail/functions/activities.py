"""Activity codes of companies and establishments."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgtrail.functions.text import or_empty, same_text, strip, text_in

# The two spellings of the classification that holds principal activities.
PRINCIPAL_CLASSIFICATIONS = ("NACEBEL", "NACEBEL_2008")
MAX_CODE_LENGTH = 10


def has_activity_prefix(activities: Column, prefix: str, classification: str | None = None) -> Column:
    """Some activity code starts with ``prefix``, in one classification if one is given."""

    def starts(code: Column) -> Column:
        return F.coalesce(F.startswith(code, F.lit(prefix)), F.lit(False))

    if classification is None:
        return F.exists(activities["code"], starts)
    hits = F.zip_with(
        activities["code"],
        activities["classification"],
        lambda code, of: starts(code) & of.eqNullSafe(classification),
    )
    return F.exists(hits, lambda hit: hit)


def _first(activities: Column, test) -> Column:
    return F.get(F.filter(activities, lambda a: F.coalesce(test(a), F.lit(False))), F.lit(0))


def principal_activity(activities: Column, rule: str = "strict") -> Column:
    """Code and description of the principal activity, each '' where missing.

    ``strict``: the first activity labelled primary in a principal classification, else the
    first of such a classification. ``contains``: the first whose classification contains
    NACE and whose label contains PRIMARY.
    """
    if rule == "strict":

        def classified(a: Column) -> Column:
            return text_in(a["classification"], PRINCIPAL_CLASSIFICATIONS)

        chosen = F.coalesce(
            _first(activities, lambda a: classified(a) & same_text(a["type_label"], "Primary")),
            _first(activities, classified),
        )
    elif rule == "contains":
        chosen = _first(
            activities,
            lambda a: F.contains(F.upper(a["classification"]), F.lit("NACE"))
            & F.contains(F.upper(a["type_label"]), F.lit("PRIMARY")),
        )
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return F.struct(
        or_empty(chosen["code"]).alias("code"),
        F.coalesce(chosen["description_nl"], chosen["description_fr"], F.lit("")).alias(
            "description"
        ),
    )


def clean_codes(codes: Column) -> Column:
    """The strings that look like a code; they keep their own blanks. Null becomes empty."""

    def looks_like_code(code: Column) -> Column:
        text = strip(code)
        return text.rlike(r"\p{Nd}") & (F.length(text) <= MAX_CODE_LENGTH)

    return F.filter(F.coalesce(codes, F.array()), looks_like_code)


def activity_codes(activities: Column) -> Column:
    """The cleaned codes of a company's activities."""
    return clean_codes(activities["code"])
