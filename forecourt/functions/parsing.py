"""Lenient parsing of text columns: invalid input becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts besides ISO (month first) by the shape of the text, true/false words,
# and the NULL markers of text files.
DATE_LAYOUTS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/yyyy H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/yyyy H:mm:ss"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
)
TRUE_WORDS, FALSE_WORDS = ("true", "1", "yes"), ("false", "0", "no")
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def instant(column: Column, is_text: bool = True) -> Column:
    """TIMESTAMP_NTZ of ISO text or of one of the other layouts."""
    if not is_text:
        return column.cast("timestamp_ntz")
    text = F.trim(column)
    layout = F
    for shape, pattern in DATE_LAYOUTS:
        layout = layout.when(text.rlike(shape), pattern)
    # ISO text never reaches the layouts; text of no known shape has a NULL layout and stays NULL.
    return F.coalesce(text.try_cast("timestamp_ntz"), F.try_to_timestamp(text, layout).cast("timestamp_ntz"))


# Every text that a cast takes for a number has this form: no names, identifiers, dates, times or phone numbers.
NUMERIC_FORM = r"(?s)^[\x00-\x20\x7f]*[+-]?(?:(?i:inf|nan).*|[\p{Nd}.][^-:]*+(?:(?<=[eEpP])-[^-:]*+)*+)$"


def _numeric(column: Column, value: Column) -> Column:
    """The value of a cast, tried only where it can succeed: a failing one costs an exception for each row."""
    return F.when(column.cast("string").rlike(NUMERIC_FORM), value)


def number(column: Column) -> Column:
    """DOUBLE, with NaN as NULL."""
    value = _numeric(column, column.try_cast("double"))
    return F.when(~F.isnan(value), value)


def amount(column: Column, kind: str = "decimal(38,10)") -> Column:
    """Exact decimal; also accepts exponent notation through DOUBLE."""
    return _numeric(column, F.coalesce(column.try_cast(kind), column.try_cast("double").try_cast(kind)))


def exact_amount(column: Column, kind: str, label: str) -> Column:
    """Like ``amount``, but a number that the kind can't hold fails the job instead of becoming NULL.

    Text that is no finite number is NULL. Fractions beyond the kind's scale are rounded.
    """
    seen = _numeric(column, column.try_cast("double"))
    real = seen.isNotNull() & ~F.isnan(seen) & (F.abs(seen) != float("inf"))
    narrow = amount(column, "decimal(38,10)").try_cast(kind)
    problem = F.concat(F.lit(f"{label} holds a number outside {kind}: "), column.cast("string"))
    return F.when(real & narrow.isNull(), F.raise_error(problem).cast(kind)).otherwise(narrow)


def truth(column: Column) -> Column:
    word = F.lower(F.trim(column.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def canonical(column: Column, values: tuple[str, ...]) -> Column:
    """The listed value that equals the text apart from case and surrounding blanks, else NULL."""
    known = F.create_map(*[F.lit(part) for value in values for part in (value.lower(), value)])
    return F.try_element_at(known, F.lower(F.trim(column)))
