"""Currency text, month labels and hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month abbreviations of the projections sheet.
MONTH_NUMBERS = {
    "jan": "01", "fev": "02", "mar": "03", "abr": "04", "mai": "05", "jun": "06",
    "jul": "07", "ago": "08", "set": "09", "out": "10", "nov": "11", "dez": "12",
}

# The characters Unicode counts as white space.
BLANKS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def currency_decimal(text: Column) -> Column:
    """``R$ 1.234,56`` to decimal(18,2), half up; text that is no amount raises an error."""
    # The comma becomes a point, every other listed character goes.
    amount = F.translate(text, "," + "R$." + BLANKS, ".").try_cast("decimal(18,2)")
    return F.when(
        text.isNotNull() & amount.isNull(),
        F.raise_error(F.concat(F.lit("not a currency amount: "), text)),
    ).otherwise(amount)


def month_label_date(label: Column) -> Column:
    """``jan/2025`` to ``01/01/2025``; an unknown month is null, a malformed label raises an error."""
    parts = F.split(F.btrim(label, F.lit(BLANKS)), "/", -1)
    numbers = F.create_map(*[F.lit(item) for pair in MONTH_NUMBERS.items() for item in pair])
    number = F.try_element_at(numbers, F.lower(F.get(parts, F.lit(0))))
    first_day = F.concat(F.lit("01/"), number, F.lit("/"), F.get(parts, F.lit(1)))
    return F.when(
        F.size(parts) == 2, first_day
    ).when(
        label.isNotNull(), F.raise_error(F.concat(F.lit("not a month label: "), label))
    )


def text_day(text: Column) -> Column:
    """``DD/MM/YYYY`` text to a date, for chronological ordering."""
    return F.to_date(text, "dd/MM/yyyy")


def md5_key(*parts: Column, sep: str = "") -> Column:
    """MD5 hex of the parts joined by ``sep``; a null part counts as empty text."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(part.cast("string"), F.lit("")) for part in parts]))
