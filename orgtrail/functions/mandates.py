"""Tests and labels on the mandates a person holds in a company."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The role labels that mean "administrator".
ADMIN_ROLES = ("ADMINISTER", "ADMINISTRATOR")
# The mandate categories of administrators and shareholders.
ADMINISTER = "ADMINISTER"
SHAREHOLDER = "SHAREHOLDER"


def role_in(role: Column, roles=ADMIN_ROLES) -> Column:
    return F.upper(F.trim(role)).isin(list(roles))


def category_in(category: Column, categories) -> Column:
    return category.isin(list(categories))


def has_category(mandates: Column, categories) -> Column:
    """Some mandate of the array has a listed category."""
    return F.exists(
        mandates["category"],
        lambda category: F.coalesce(category_in(category, categories), F.lit(False)),
    )


def nonempty(array: Column) -> Column:
    """The array has elements; a null array is dropped."""
    return F.size(array) > 0


def rep_status(end_date: Column, upper: bool = False) -> Column:
    """Current without an end date, else previous."""
    current, previous = ("CURRENT", "PREVIOUS") if upper else ("current", "previous")
    return F.when(end_date.isNull(), current).otherwise(previous)


def rep_type(is_moral: Column) -> Column:
    """moral, physical, or '' where the flag is unknown."""
    return F.when(is_moral, "moral").when(~is_moral, "physical").otherwise("")


def rep_type_by_pid(pid: Column) -> Column:
    """physical if the mandate names a person, else moral."""
    return F.when(pid.isNotNull(), "physical").otherwise("moral")
