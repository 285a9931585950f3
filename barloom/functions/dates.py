"""Date helpers as column functions. Dates are DateType; text forms are strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month and day names in order.
MONTHS = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]


DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _part(text: Column, first, length) -> Column:
    return F.substring(text, first, length)


def _name(names, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


# ---- a date to text or numbers ---------------------------------------------------
# Text forms are cut from one ISO rendering, which Spark computes once per row.


def _iso(d: Column) -> Column:
    return d.cast("string")


def ddmmyy(d: Column) -> Column:
    return F.concat(_part(_iso(d), 9, 2), _part(_iso(d), 6, 2), _part(_iso(d), 3, 2))


def ddmmyyyy(d: Column) -> Column:
    return F.concat(_part(_iso(d), 9, 2), _part(_iso(d), 6, 2), _part(_iso(d), 1, 4))


def ddMMMyyyy(d: Column) -> Column:
    return F.concat(_part(_iso(d), 9, 2), MMM(d), _part(_iso(d), 1, 4))


def yyyy(d: Column) -> Column:
    return _part(_iso(d), 1, 4)


def mm_int(d: Column) -> Column:
    return F.month(d)


def MMM(d: Column) -> Column:
    return _name([m[:3].upper() for m in MONTHS], F.month(d))


def weekday(d: Column) -> Column:
    """Monday is 0."""
    return F.weekday(d)


def dayofweek(d: Column) -> Column:
    return _name(DAYS, F.weekday(d) + 1)


# ---- arithmetic ------------------------------------------------------------------


def relativedate(d: Column, years=0, months=0, days=0) -> Column:
    """Years and months first, clamped to the month's end, then days."""
    return F.date_add(F.add_months(d, 12 * years + months), days)


def setdate(d: Column, year=0, month=0, day=0) -> Column:
    """Replace the parts that are not 0; a date that does not exist is null."""
    parts = [
        F.lit(f"{year:04d}") if year > 0 else _part(_iso(d), 1, 4),
        F.lit(f"{month:02d}") if month > 0 else _part(_iso(d), 6, 2),
        F.lit(f"{day:02d}") if day > 0 else _part(_iso(d), 9, 2),
    ]
    return F.concat_ws("-", *parts).try_cast("date")


def datediff(first: Column, second: Column = None) -> Column:
    """Days from `second` to `first`; one array column may hold the pair."""
    if second is None:
        first, second = first[0], first[1]
    return F.datediff(first, second)


# ---- text to date, text to text --------------------------------------------------
# Like the inputs they stand for, these only rearrange characters.


def todate(text: Column) -> Column:
    """`yyyymmdd` to a date; null where it is none."""
    return yyyymmdd_to_yyyy_mm_dd(text).try_cast("date")


def yyyy_mm_dd_to_yyyymmdd(text: Column) -> Column:
    return F.concat(_part(text, 1, 4), _part(text, 6, 2), _part(text, 9, 2))


def yyyymmdd_to_yyyy_mm_dd(text: Column) -> Column:
    return F.concat_ws("-", _part(text, 1, 4), _part(text, 5, 2), _part(text, 7, 2))


def mm_dd_yyyy_to_yyyy_mm_dd(text: Column, sep="-") -> Column:
    """Any one-character separators in the input; `sep` in the output."""
    return F.concat_ws(sep, _part(text, 7, 4), _part(text, 1, 2), _part(text, 4, 2))


def ddmmyy_to_yyyy_mm_dd(text: Column) -> Column:
    """Two-digit years above 60 belong to the 1900s."""
    century = F.when(_part(text, 5, 2) > "60", "19").otherwise("20")
    return F.concat_ws("-", F.concat(century, _part(text, 5, 2)), _part(text, 3, 2), _part(text, 1, 2))


def ddMMMyyyy_to_yyyy_mm_dd(text: Column) -> Column:
    return F.concat(_part(text, 6, 4), F.lit("-"), mm(_part(text, 3, 3)), F.lit("-"), _part(text, 1, 2))


def dd_MMM_yyyy_to_yyyy_mm_dd(text: Column) -> Column:
    return F.concat(_part(text, 8, 4), F.lit("-"), mm(_part(text, 4, 3)), F.lit("-"), _part(text, 1, 2))


def ddmmyyyy_to_yyyy_mm_dd(text: Column) -> Column:
    return F.concat_ws("-", _part(text, 5, 4), _part(text, 3, 2), _part(text, 1, 2))


def dd_mm_yyyy_to_yyyymmdd(text: Column) -> Column:
    return F.concat(_part(text, 7, 4), _part(text, 4, 2), _part(text, 1, 2))


# ---- month names -----------------------------------------------------------------


def _lookup(pairs) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def mm(name: Column) -> Column:
    """Full or three-letter month name in any case to its two digits; unknown is null."""
    numbered = list(enumerate(MONTHS, start=1))
    pairs = {m.upper(): f"{n:02d}" for n, m in numbered} | {m[:3].upper(): f"{n:02d}" for n, m in numbered}
    return F.try_element_at(_lookup(pairs.items()), F.upper(name))


def months(number: Column, format="x") -> Column:
    """Month number (or its text) to a name: full, `Mmm`, `MMM` or `mmm`; out of range is null."""
    name = F.try_element_at(_lookup(enumerate(MONTHS, start=1)), number.try_cast("int"))
    if format == "Mmm":
        return F.substring(name, 1, 3)
    if format == "MMM":
        return F.upper(F.substring(name, 1, 3))
    if format == "mmm":
        return F.lower(F.substring(name, 1, 3))
    return name
