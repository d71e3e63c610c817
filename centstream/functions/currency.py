"""Money columns: minor units to exact decimals, and display text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currencies whose minor unit is the major unit.
ZERO_DECIMAL = (
    "bif", "clp", "djf", "gnf", "jpy", "kmf", "krw", "mga",
    "pyg", "rwf", "ugx", "vnd", "vuv", "xaf", "xof", "xpf",
)

# Currencies with a thousand minor units to the major unit.
THREE_DECIMAL = ("bhd", "jod", "kwd", "omr", "tnd")

# Display symbols.
SYMBOLS = {"gbp": "£", "eur": "€", "usd": "$", "jpy": "¥"}


def decimals(currency: Column) -> Column:
    """Number of decimal places a currency is quoted in (2 when unknown or null)."""
    code = F.lower(currency)
    return (
        F.when(code.isin(*ZERO_DECIMAL), F.lit(0))
        .when(code.isin(*THREE_DECIMAL), F.lit(3))
        .otherwise(F.lit(2))
    )


def minor_unit_divisor(currency: Column) -> Column:
    """Minor units per major unit: 1, 100 or 1000."""
    places = decimals(currency)
    return F.when(places == 0, 1).when(places == 3, 1000).otherwise(100)


def amount_major(amount_minor: Column, currency: Column) -> Column:
    """Exact DECIMAL(18,3) amount; null when it does not fit.

    Multiplying by a decimal keeps every digit, where dividing two integers
    would go through DOUBLE.
    """
    places = decimals(currency)
    unit = (
        F.when(places == 0, F.lit("1.000"))
        .when(places == 3, F.lit("0.001"))
        .otherwise(F.lit("0.010"))
        .cast("decimal(4,3)")
    )
    return (amount_minor.cast("decimal(19,0)") * unit).try_cast("decimal(18,3)")


def format_money(amount: Column, currency: Column) -> Column:
    """Symbol (or code and a blank), then the amount with grouped thousands."""
    code = F.lower(currency)
    pairs = [F.lit(part) for pair in SYMBOLS.items() for part in pair]
    symbol = F.coalesce(
        F.try_element_at(F.create_map(*pairs), code), F.concat(F.upper(code), F.lit(" "))
    )
    digits = F.call_function(
        "format_number", F.coalesce(amount, F.lit(0).cast("decimal(18,3)")), decimals(currency)
    )
    return F.concat(symbol, digits)


def format_count(value: Column) -> Column:
    """Whole number with grouped thousands."""
    return F.format_number(F.coalesce(value, F.lit(0)), 0)


def format_percent(value: Column) -> Column:
    """One decimal place, ties to even, and a percent sign."""
    return F.concat(F.format_number(value, 1), F.lit("%"))


def success_rate(successful: Column, total: Column) -> Column:
    """Share of successful events in percent; 0 when there are none."""
    return F.when(total > 0, successful.cast("double") / total * 100).otherwise(F.lit(0.0))
