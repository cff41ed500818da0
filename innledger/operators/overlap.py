"""Pairs of stays that overlap in the same room.

Two stays overlap when each begins before the other ends. With check-in never after
check-out, that happens in exactly one of two ways:

* both last at least a night and begin on the same day, or
* one begins on a day strictly inside the other (after its check-in, before its
  check-out).

Both are equality joins once the inside of a stay is written as blocks of days. A block
of level ``k`` is ``16**k`` days long and starts at a multiple of its length; any range of
days is a short list of such blocks, none overlapping another. A check-in day lies in one
block per level, so it meets a stay around it in exactly one block, once.

Hence the join key is (room, level, block), and work grows with input and output, not with
the square of a room. Two things keep keys and rows few. What lies after the last check-in
of a room meets nobody, so a stay counts only up to there: an open-ended check-out makes no
more blocks than the room's calendar has. And the largest blocks have 256 days: a room that
holds much of the table is spread over its calendar by them, and stays that are longer are
a block per 256 days. A room's check-ins go only to the levels that a stay of that room
reaches. Largest key: the check-ins of one room in 256 days; adaptive execution splits it.

Times of day are compared as they are; blocks are made of the days they fall in.

Repeated stays are joined once, with their number. In most rooms no stay is repeated often,
and pairs are written as often as they stand where they are found. Rooms with a stay that is
repeated very often are joined on their own, and the copies of their pairs are dealt out.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.operators.copies import (
    CHUNK,
    collapse_copies,
    expand_dealt,
    expand_in_place,
)

_BITS = 4  # a block holds 2**4 = 16 blocks of the level below
_MAX_LEVEL = 2  # blocks of 256 days
_SAME_DAY = -1  # the level for stays that begin on the same day
_OFTEN = int(CHUNK**0.5)  # two stays repeated so often make a chunk of pairs


def _day(column: str) -> str:
    """Days since 1970."""
    return f"CAST(unix_date(CAST({column} AS DATE)) AS BIGINT)"


def _first(level: str) -> str:
    """The first block that lies wholly after the check-in day."""
    return f"shiftright(s + shiftleft(1L, {_BITS} * ({level})), {_BITS} * ({level}))"


def _stop(level: str) -> str:
    """The block after the last one that lies wholly before the check-out day."""
    return f"shiftright(e, {_BITS} * ({level}))"


def _range(start: str, stop: str) -> str:
    empty = "CAST(array() AS ARRAY<BIGINT>)"
    return f"CASE WHEN {start} < {stop} THEN sequence({start}, {stop} - 1) ELSE {empty} END"


def _around(stays: DataFrame) -> DataFrame:
    """One row per block that is inside the stay, and one for its first day.

    Where blocks of the level above cover the middle, a level fills in the two ends; the
    highest level has nothing above it and fills in all.
    """
    inside = f"concat({_range('first', 'before_stop')}, {_range('after_first', 'stop')})"
    return (
        stays.selectExpr(
            "*",
            f"{_first('level')} AS first",
            f"{_stop('level')} AS stop",
            f"{_first('level + 1')} * {1 << _BITS} AS middle_first",
            f"{_stop('level + 1')} * {1 << _BITS} AS middle_stop",
        )
        .selectExpr(
            "*",
            f"if(level < {_MAX_LEVEL} AND middle_first < middle_stop, middle_first, stop)"
            " AS before_stop",
            f"if(level < {_MAX_LEVEL} AND middle_first < middle_stop, middle_stop, stop)"
            " AS after_first",
        )
        .selectExpr(
            *stays.columns,
            f"explode(CASE WHEN level != {_SAME_DAY} THEN {inside}"
            " WHEN whole_e > s THEN array(s) END) AS block",
        )
    )


def _begins(stays: DataFrame) -> DataFrame:
    """One row per block the check-in day lies in, and one for the day itself."""
    return stays.selectExpr(
        "*",
        f"CASE WHEN level != {_SAME_DAY} THEN shiftright(s, {_BITS} * level)"
        " WHEN whole_e > s THEN s END AS block",
    ).filter("block IS NOT NULL")


def overlapping_pairs(
    df: DataFrame,
    room: str = "room_id",
    booking: str = "booking_id",
    checkin: str = "checkin_date",
    checkout: str = "checkout_date",
) -> DataFrame:
    """All pairs of different bookings of a room whose stays overlap.

    The lower booking id comes first. Rows with a NULL among the four columns match
    nothing. Dates must not be inverted (``functions.cleaning.ordered_dates``); they may
    have a time of day. Repeated rows give repeated pairs, as a plain self-join would.
    """
    kind = "DATE"
    if any(df.schema[c].dataType.simpleString() != "date" for c in (checkin, checkout)):
        kind = "TIMESTAMP"
    known = df.selectExpr(
        f"`{room}` AS room",
        f"`{booking}` AS id",
        f"CAST(`{checkin}` AS {kind}) AS begins",
        f"CAST(`{checkout}` AS {kind}) AS ends",
    ).dropna()
    # The day after the last one that the stay takes part of.
    stop = f"{_day('ends')} + CAST(ends > CAST(CAST(ends AS DATE) AS {kind}) AS INT)"
    days = collapse_copies(known, ["room", "id", "begins", "ends"], "copies").selectExpr(
        "*", f"{_day('begins')} AS s", f"{stop} AS whole_e"
    )
    longest = "least(max(whole_e - s), max(s) + 1 - min(s))"
    reached = " + ".join(
        f"CAST({longest} > {1 << _BITS * level} AS INT)" for level in range(_MAX_LEVEL + 1)
    )
    of_room = days.groupBy(F.col("room").alias("of_room")).agg(
        F.expr("max(s) + 1 AS after_last"),
        F.expr(f"{reached} - 1 AS top_level"),
        F.expr(f"max(copies) > {_OFTEN} AS often"),
    )
    stays = days.join(of_room, F.col("room") == F.col("of_room")).selectExpr(
        "room", "id", "begins", "ends", "copies", "s", "whole_e", "often",
        "greatest(s, least(whole_e, after_last)) AS e",
        f"explode(sequence({_SAME_DAY}, top_level)) AS level",
    )
    few = _pairs(stays.filter("NOT often").drop("often"), room, booking)
    many = _pairs(stays.filter("often").drop("often"), room, booking)
    return expand_in_place(few, "copies").unionByName(expand_dealt(many, "copies"))


def _pairs(stays: DataFrame, room: str, booking: str) -> DataFrame:
    """Each pair once, with how often it stands."""
    # Spark's size estimate leaves out that one stay becomes many blocks, so it must not
    # choose to broadcast by it.
    return (
        _around(stays)
        .alias("a")
        .join(
            _begins(stays).hint("merge").alias("b"),
            F.expr(
                "a.room = b.room AND a.level = b.level AND a.block = b.block AND a.id != b.id"
                f" AND (a.level != {_SAME_DAY} OR a.id < b.id)"
                " AND a.begins < b.ends AND b.begins < a.ends"
            ),
        )
        .selectExpr(
            f"a.room AS `{room}`",
            f"least(a.id, b.id) AS `{booking}_1`",
            f"greatest(a.id, b.id) AS `{booking}_2`",
            "greatest(a.begins, b.begins) AS overlap_start",
            "least(a.ends, b.ends) AS overlap_end",
            "a.copies * b.copies AS copies",
        )
    )
