"""Choosing one entry of an address history, and writing an address as text.

"Current", "latest", "last" and "previous" each have their own rule, and so has each
text style. The picks carry the array position as their last sort field, so that of
equal entries the later one wins.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgtrail.functions.text import or_empty, strip

# Fixed value: what a missing start date counts as when entries are ranked by (end, start).
EPOCH = "1970-01-01"


def _by_end_start(hist: Column) -> list[Column]:
    """Open entries last, then by end; a missing start counts as the epoch."""
    epoch = F.to_date(F.lit(EPOCH))
    return [
        hist["end_date"].isNull().alias("open"),
        hist["end_date"].alias("end"),
        F.coalesce(hist["start_date"], epoch).alias("start"),
    ]


def pick_by(hists: Column, rank: Callable[[Column], list[Column]]) -> Column:
    """The entry with the highest rank, null for an empty history; a null rank field is lowest.

    The entry travels behind its rank and position. The position is unique, so the entry
    itself is never compared.
    """
    ranked = F.transform(
        hists, lambda hist, at: F.struct(*rank(hist), at.alias("at"), hist.alias("hist"))
    )
    return F.array_max(ranked)["hist"]


def latest_hist(hists: Column) -> Column:
    """Latest by (end, start); no end is the latest of all, no start is the epoch."""
    return pick_by(hists, _by_end_start)


def current_or_latest_hist(hists: Column) -> Column:
    """The open entry with the latest start; if none is open, the latest start of all."""
    return pick_by(
        hists,
        lambda hist: [hist["end_date"].isNull().alias("open"), hist["start_date"].alias("start")],
    )


def first_open_or_last_hist(hists: Column) -> Column:
    """The first open entry in array order, else the last entry."""
    still_open = F.filter(hists, lambda hist: hist["end_date"].isNull())
    return F.coalesce(F.get(still_open, F.lit(0)), last_hist(hists))


def previous_hist(hists: Column) -> Column:
    """The closed entry with the latest end."""
    closed = F.filter(hists, lambda hist: hist["end_date"].isNotNull())
    return pick_by(closed, lambda hist: [hist["end_date"].alias("end")])


def last_closed_hist(hists: Column) -> Column:
    """The last closed entry in array order."""
    return last_hist(F.filter(hists, lambda hist: hist["end_date"].isNotNull()))


def last_hist(hists: Column) -> Column:
    """The last array element, null for an empty history."""
    return F.try_element_at(hists, F.lit(-1))


def sort_hists(hists: Column, by: str = "end_start") -> Column:
    """The whole history, ascending by ``end_start``, ``start`` or ``end``."""
    ranks = {
        "end_start": _by_end_start,
        "start": lambda hist: [hist["start_date"].alias("start")],
        "end": lambda hist: [hist["end_date"].alias("end")],
    }
    rank = ranks[by]
    keyed = F.transform(
        hists, lambda hist, at: F.struct(*rank(hist), at.alias("at"), hist.alias("hist"))
    )
    return F.transform(F.sort_array(keyed), lambda item: item["hist"])


def _filled(text: Column) -> Column:
    """The text, or null where it is empty, so that ``concat_ws`` skips it."""
    return F.nullif(text, F.lit(""))


def _line(address: Column) -> Column:
    parts = [_filled(address[name]) for name in ("street", "number", "box")]
    return strip(F.concat_ws(" ", *parts))


def fmt_address(address: Column, style: str) -> Column:
    """An address as text.

    ==============  ===============================================  =========  ==========
    style           fields                                           skips      no address
    ==============  ===============================================  =========  ==========
    comma_trim      street number zip city box country, trimmed      blanks     ''
    comma_nulls     number street zip city province country          nulls      null
    concat_ws       number street zip city province country          nulls      ''
    comma_space     street number zip city country                   empties    ''
    line            street number box                                empties    ''
    full            line, zip city, country                          nothing    ''
    ==============  ===============================================  =========  ==========
    """
    if style == "comma_trim":
        names = ("street", "number", "zip_code", "city", "box", "country_code")
        return F.concat_ws(",", *[_filled(strip(address[name])) for name in names])
    if style in ("comma_nulls", "concat_ws"):
        names = ("number", "street", "zip_code", "city", "province", "country_code")
        text = F.concat_ws(",", *[address[name] for name in names])
        return F.when(address.isNotNull(), text) if style == "comma_nulls" else text
    if style == "comma_space":
        names = ("street", "number", "zip_code", "city", "country_code")
        return F.concat_ws(", ", *[_filled(address[name]) for name in names])
    if style == "line":
        return _line(address)
    if style == "full":
        text = F.concat(
            _line(address),
            F.lit(", "),
            address_part(address, "zip_code"),
            F.lit(" "),
            address_part(address, "city"),
            F.lit(", "),
            address_part(address, "country_code"),
        )
        return F.when(address.isNotNull(), text).otherwise("")
    raise ValueError(f"unknown address style {style!r}")


def address_part(address: Column, field: str) -> Column:
    """One field of an address, '' where it is missing."""
    return or_empty(address[field])
