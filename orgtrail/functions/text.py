"""Text rules shared by the other column builders."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters up to and including the space, which is what the JVM's
# own trim removes. Spark's trim removes the space alone.
BLANKS = "".join(chr(code) for code in range(0x21))


def strip(text: Column) -> Column:
    """Trim spaces, tabs, line ends and control characters."""
    return F.btrim(text, F.lit(BLANKS))


def nonblank(text: Column) -> Column:
    """The trimmed key is not empty; a null key is dropped."""
    return F.length(F.trim(text)) > 0


def same_text(text: Column, value: str) -> Column:
    """Equality that ignores case."""
    return F.upper(text) == value.upper()


def text_in(text: Column, values) -> Column:
    """Membership that ignores case."""
    return F.upper(text).isin([value.upper() for value in values])


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))
