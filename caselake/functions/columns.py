"""Cleaning, safe casts, flags, rates and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (general category Zs). Tabs and line ends stay.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

ISO_DATE = r"^\d{4}([-/])\d{1,2}\1\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?\z"

# Product wording -> stable product group, tried from top to bottom.
# A trailing % means "starts with, any case"; otherwise the whole text must be equal.
PRODUCT_GROUP_RULES = [
    ("Credit reporting", ["credit reporting%"]),
    ("Debt collection", ["debt collection%"]),
    ("Mortgage", ["mortgage%"]),
    ("Bank accounts", ["Bank account or service", "Checking or savings account"]),
    ("Credit and prepaid cards", ["credit card%", "Prepaid card"]),
    ("Money transfers", ["money transfer%", "Virtual currency"]),
    ("Personal and payday loans", ["payday loan%", "Consumer Loan"]),
    ("Vehicle loans", ["Vehicle loan or lease"]),
    ("Student loans", ["Student loan"]),
    ("Debt or credit management", ["Debt or credit management"]),
]


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: Column | str) -> Column:
    """Trim every kind of space from both ends (a plain trim only knows U+0020).

    Pure ASCII text, which is as many bytes as characters, takes the much cheaper plain trim.
    """
    c = as_column(c)
    return F.when(F.octet_length(c) == F.length(c), F.trim(c)).otherwise(F.btrim(c, F.lit(SPACE_SEPARATORS)))


def clean_text(c: Column | str, default: str | None = None) -> Column:
    """Trim; blank becomes NULL, or ``default`` where one is given."""
    text = F.nullif(trim_spaces(c), F.lit(""))
    return text if default is None else F.coalesce(text, F.lit(default))


def safe_long(c: Column | str) -> Column:
    """Whole numbers only; anything else is NULL."""
    return trim_spaces(c).try_cast("bigint")


def safe_date(c: Column | str) -> Column:
    """A complete year-month-day (dash or slash), optionally with a time; anything else is NULL."""
    text = trim_spaces(c)
    dashed = F.when(F.contains(text, F.lit("/")), F.translate(text, "/", "-")).otherwise(text)  # few have slashes
    return F.when(text.rlike(ISO_DATE), dashed).try_cast("date")


def yes_no(c: Column | str) -> Column:
    """'Yes' / 'No' -> true / false; anything else stays unknown (NULL)."""
    text = trim_spaces(c)
    return F.when(text == "Yes", F.lit(True)).when(text == "No", F.lit(False))


def flag_to_int(c: Column | str) -> Column:
    """true / false / NULL -> 1 / 0 / NULL, ready to be summed."""
    return as_column(c).cast("int")


def product_group(product: Column | str) -> Column:
    """Searched CASE over PRODUCT_GROUP_RULES; unknown wording is kept as it is."""
    product = as_column(product)

    def matches(text: str) -> Column:
        return product.ilike(text) if text.endswith("%") else product == text

    chain = F
    for group, texts in PRODUCT_GROUP_RULES:
        condition = matches(texts[0])
        for text in texts[1:]:
            condition = condition | matches(text)
        chain = chain.when(condition, F.lit(group))
    return chain.otherwise(product)


def round_half(x: Column, digits: int) -> Column:
    """Round a DOUBLE on its scaled binary value, not on its decimal text (1.005 -> 1.0)."""
    scale = float(10**digits)
    return F.round(x.cast("double") * F.lit(scale), 0) / F.lit(scale)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole in DOUBLE; NULL where nothing is known."""
    return round_half(
        F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits
    )


def month_of(d: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(as_column(d), "MM")


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_column(end), as_column(start)).cast("bigint")


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of full-hour marks passed from ``start`` to ``end`` (not whole elapsed hours)."""

    def hours(ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(3600))

    return hours(end) - hours(start)


def date_key(d: Column | str) -> Column:
    """YYYYMMDD as an integer; NULL stays NULL."""
    d = as_column(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_fields(d: Column | str) -> dict[str, Column]:
    """The descriptive columns of a calendar day (ISO weekday, full English names)."""
    d = as_column(d)
    weekday = F.weekday(d) + 1
    return {
        "year": F.year(d).cast("smallint"),
        "quarter": F.quarter(d).cast("smallint"),
        "month": F.month(d).cast("smallint"),
        "month_name": F.date_format(d, "MMMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "day_of_week": weekday.cast("smallint"),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekday.isin(6, 7),
    }


def fit_width(c: Column | str, width: int) -> Column:
    """Cut text to a column width."""
    return F.left(as_column(c), F.lit(width))


def starts_with(c: Column | str, prefix: str, ignore_case: bool = False) -> Column:
    """Literal prefix match: wildcard characters in ``prefix`` have no meaning."""
    c, value = as_column(c), F.lit(prefix)
    return F.startswith(F.lower(c), F.lower(value)) if ignore_case else F.startswith(c, value)
