"""Calendar and room features of one stay."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code of each room type, and the code of every other type.
ROOM_TYPE_NUMBERS = {"single": 1, "double": 2, "suite": 3, "family": 4}
OTHER_ROOM_TYPE = 2


def stay_nights(checkin: str, checkout: str) -> Column:
    return F.expr(f"datediff({checkout}, {checkin})")


def season(day: str) -> Column:
    """1 for January to March, up to 4 for October to December."""
    return F.expr(f"quarter({day})")


def is_weekend(day: str) -> Column:
    """1 on Saturday and Sunday. ``weekday`` counts from Monday = 0."""
    return F.expr(f"CAST(weekday({day}) >= 5 AS INT)")


def room_type_number(code: str, numbers: Mapping[str, int] | None = None) -> Column:
    numbers = ROOM_TYPE_NUMBERS if numbers is None else numbers
    cases = " ".join(f"WHEN {name!r} THEN {number}" for name, number in numbers.items())
    if not cases:
        return F.lit(OTHER_ROOM_TYPE)
    return F.expr(f"CASE {code} {cases} ELSE {OTHER_ROOM_TYPE} END")
