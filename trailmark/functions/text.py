"""Text expressions: page-title codec and number formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_title(title: Column) -> Column:
    """Blanks to underscores, then percent-encode all but ``A-Za-z0-9_.-~``."""
    form = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    return F.replace(F.replace(form, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def decode_title(encoded: Column) -> Column:
    """Percent-decode (a literal plus stays), then underscores to blanks."""
    plain = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.replace(plain, F.lit("_"), F.lit(" "))


def fixed(value: Column, digits: int) -> Column:
    """A number with a fixed count of decimals and no grouping."""
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def grouped(value: Column) -> Column:
    """A whole number with commas between thousands."""
    return F.call_function("format_number", value, F.lit("#,##0"))


def percent(value: Column, digits: int = 1) -> Column:
    return F.concat(fixed(value * 100, digits), F.lit("%"))
