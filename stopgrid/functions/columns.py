"""Column expressions: coercion, dates, guarded arithmetic, crowding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopgrid import schema as S


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- coercion ---------------------------------------------------------------
def to_number(col: Column | str) -> Column:
    """Text to double; text that is no number becomes null."""
    c = F.trim(_c(col).cast("string"))
    # Java also reads '1d' and '1f' as numbers
    return F.when(~F.substring(c, -1, 1).isin("d", "D", "f", "F"), c.try_cast("double"))


def number_or_zero(col: Column | str) -> Column:
    return F.coalesce(F.nanvl(to_number(col), F.lit(0.0)), F.lit(0.0))


def whole_or_zero(col: Column | str) -> Column:
    """Numeric text cut to a whole number ('3.7' -> 3, '-3' -> -3, bad -> 0)."""
    return F.coalesce(to_number(col).try_cast("bigint"), F.lit(0).cast("bigint"))


def digits_or_zero(col: Column | str) -> Column:
    """Only plain digits count ('-3' and '3.0' -> 0)."""
    c = _c(col)
    return F.coalesce(
        F.when(c.rlike(r"^\s*\d+\s*$"), F.trim(c).try_cast("bigint")), F.lit(0).cast("bigint")
    )


def integer_or_zero(col: Column | str) -> Column:
    """Signed whole-number text; anything else, also '3.0', -> 0."""
    c = _c(col)
    return F.coalesce(
        F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("bigint")), F.lit(0).cast("bigint")
    )


def digits_only(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), "[^0-9]", "")


# -- dates ------------------------------------------------------------------
def parse_date(col: Column | str) -> Column:
    """'20240131' or '2024-01-31' to a date, anything else to null."""
    c = F.trim(_c(col).cast("string"))
    return F.coalesce(F.try_to_date(c, "yyyyMMdd"), F.try_to_date(c, "yyyy-MM-dd"))


def use_ym(date_text: Column | str) -> Column:
    return F.substring(F.regexp_replace(_c(date_text), "-", ""), 1, 6)


def month_of(date: Column | str) -> Column:
    """'YYYYMM' of a date."""
    return F.substring(compact_date(date), 1, 6)


def compact_date(date: Column | str) -> Column:
    return F.replace(_c(date).cast("string"), F.lit("-"), F.lit(""))


def two_digits(number: Column | str) -> Column:
    """At least two digits with a leading zero."""
    text = _c(number).cast("string")
    return F.when(_c(number) < 10, F.concat(F.lit("0"), text)).otherwise(text)


def hour_index(date: Column | str, hour: Column | str) -> Column:
    """Hours since 1970-01-01 00:00, an ordering key for (date, hour)."""
    return (F.unix_date(_c(date)).cast("bigint") * 24 + _c(hour)).cast("bigint")


def moment(date: Column | str, us_of_day: Column | str) -> Column:
    """Date plus microseconds since its midnight, without a time zone."""
    seconds = (_c(us_of_day).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return _c(date).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


# -- guarded arithmetic -----------------------------------------------------
def clip_zero(col: Column | str) -> Column:
    """Negative to 0; null stays null."""
    c = _c(col)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, null where den is 0 or null."""
    d = _c(den)
    return F.when(d != 0, _c(num) / d)


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def minutes_between(buses: Column | str) -> Column:
    """Headway in minutes, null without buses."""
    b = _c(buses)
    return F.when(b > 0, F.lit(60.0) / b)


def capped_headway(buses: Column | str) -> Column:
    h = F.coalesce(minutes_between(buses), F.lit(S.HEADWAY_MAX))
    return F.least(F.greatest(h, F.lit(S.HEADWAY_MIN)), F.lit(S.HEADWAY_MAX))


# -- crowding and speed -----------------------------------------------------
def crowding(load: Column | str) -> Column:
    x = _c(load)
    return (
        F.when(x <= S.SEATS, F.lit("free"))
        .when(x <= S.CROWDED_LOAD, F.lit("normal"))
        .otherwise(F.lit("crowded"))
    )


def is_crowded(load: Column | str) -> Column:
    return F.coalesce((_c(load) > S.CROWDED_LOAD).cast("int"), F.lit(0))


def in_peak(us_of_day: Column) -> Column:
    """Whether a time in microseconds since midnight lies in a rush hour."""
    us = F.pmod(us_of_day, F.lit(S.US_PER_DAY))
    peak = F.lit(False)
    for first, last in S.PEAK_HOURS:
        peak = peak | ((us >= first * S.US_PER_HOUR) & (us < (last + 1) * S.US_PER_HOUR))
    return peak
