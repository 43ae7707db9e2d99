"""Feature expressions of the property mart, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data: the masked station name is four full-width
# asterisks (U+FF0A), an address group is the first 12 characters, one minute
# on foot is 80 metres.
MASKED_STATION = "＊＊＊＊"
ADDR_GROUP_CHARS = 12
METRES_PER_MINUTE = 80.0


def addr_group(address: Column, chars: int = ADDR_GROUP_CHARS) -> Column:
    """The first ``chars`` characters (code points) of an address."""
    return F.left(address.cast("string"), F.lit(chars))


def area_recover(area: Column, area_min: Column, area_max: Column) -> Column:
    """The area, else the middle of its bounds; NULL if a bound is missing."""
    return F.coalesce(area.cast("double"), (area_max.cast("double") + area_min.cast("double")) / F.lit(2.0))


def ym_to_months(ym: Column) -> Column:
    """YYYYMM as a count of months."""
    return F.floor(ym / F.lit(100)) * F.lit(12) + ym % F.lit(100)


def age_years(target_ym: Column, built_ym: Column) -> Column:
    """Years between two YYYYMM values, exact to the month."""
    return (ym_to_months(target_ym) - ym_to_months(built_ym)).cast("double") / F.lit(12.0).cast("double")


def station_recover(listed: Column, nearest: Column, mask: str = MASKED_STATION) -> Column:
    """The listed station unless it is missing or masked, else the nearest."""
    return F.when(listed.isNull() | (listed == F.lit(mask)), nearest).otherwise(listed)


def walk_recover(minutes: Column, metres: Column, metres_per_minute: float = METRES_PER_MINUTE) -> Column:
    """Listed walking minutes in metres, else the straight-line distance."""
    return F.coalesce(minutes * F.lit(metres_per_minute), metres)


def growth_rate(latest: Column, base: Column) -> Column:
    """Relative change from ``base`` to ``latest``; NULL for a zero base."""
    return (latest - base).cast("double") / F.nullif(base.cast("double"), F.lit(0.0))


def unit_price(price: Column, area: Column) -> Column:
    """Price per area; NULL for a zero area, which a mean then skips."""
    return F.try_divide(price.cast("double"), area.cast("double"))


def interaction(area: Column, age: Column) -> Column:
    """Product of area and age."""
    return area * age
