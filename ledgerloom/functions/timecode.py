"""Dates and period codes. A code has a place for each unit, X where a unit doesn't apply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ROMAN = ["I", "II", "III", "IV"]


def _month(c: Column) -> Column:
    n = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.lower(F.left(c, F.lit(3))))
    return F.when(n > 0, F.lpad(n.cast("string"), 2, "0"))


def survey_period(year: Column, period: Column) -> Column:
    """YYYYhqmm of a year and a period: M01 to M12, Q1 to Q4, S1 and S2; M13, Q5, S3 and A.. are the whole year; others fail."""
    y, p = F.lpad(year.cast("string"), 4, "0"), F.trim(period)
    return (
        F.when(p.rlike("^M(0[1-9]|1[0-2])$"), F.concat(y, F.lit("XX"), F.substr(p, F.lit(2), F.lit(2))))
        .when(p.rlike("^Q0?[1-4]$"), F.concat(y, F.lit("X"), F.right(p, F.lit(1)), F.lit("XX")))
        .when(p.rlike("^S0?[12]$"), F.concat(y, F.right(p, F.lit(1)), F.lit("XXX")))
        .when(p.rlike("^(M13|Q0?5|S0?3|A[0-9]*)$"), F.concat(y, F.lit("XXXX")))
        .when(period.isNotNull(), F.raise_error(F.concat(F.lit("no period code: "), p)).cast("string"))
    )


def account_period(c: Column) -> Column:
    """YYYYqmm of 1929, 1947-I (a quarter) or 1959-Jan (a month); null for anything else."""
    y, rest = F.left(c, F.lit(4)), F.upper(F.regexp_extract(c, r"^[0-9]{4}[-. ]?([A-Za-z]+)$", 1))
    quarter = F.array_position(F.array(*(F.lit(r) for r in ROMAN)), rest)
    return (
        F.when(c.rlike(r"^[0-9]{4}$"), F.concat(y, F.lit("XXX")))
        .when((rest != "") & (quarter > 0), F.concat(y, quarter.cast("string"), F.lit("XX")))
        .when(rest != "", F.concat(y, F.lit("X"), _month(rest)))
    )


def income_period(c: Column) -> Column:
    """YYYYqXX of 2009 or 2009.1; null for anything else."""
    return F.when(c.rlike(r"^[0-9]{4}\.[1-4]$"), F.concat(F.left(c, F.lit(4)), F.right(c, F.lit(1)), F.lit("XX"))).when(c.rlike(r"^[0-9]{4}$"), F.concat(c, F.lit("XXX")))


def last_of_range(c: Column) -> Column:
    """The last year of 1969-1999, or the year itself; null for anything else."""
    return F.when(c.rlike(r"^[0-9]{4}(-[0-9]{4})?$"), F.right(c, F.lit(4)))


def typed_date(c: Column) -> Column:
    """1-Jan-00 as YYYYMMDD (50 and later in the 1900s), 1/10/2001 and 20010110 as YYYY-MM-DD; anything else as it is."""
    day = r"([0-9]{1,2})-([A-Za-z]{3})-([0-9]{2})"
    yy = F.regexp_extract(c, day, 3)
    short = F.concat(F.when(yy.try_cast("int") >= 50, "19").otherwise("20"), yy, _month(F.regexp_extract(c, day, 2)), F.lpad(F.regexp_extract(c, day, 1), 2, "0"))
    us = r"(1[0-2]|0?[0-9])/([0-3]?[0-9])/(1[7-9][0-9]{2}|20[0-9]{2})"
    slashed = F.concat_ws("-", F.regexp_extract(c, us, 3), F.lpad(F.regexp_extract(c, us, 1), 2, "0"), F.lpad(F.regexp_extract(c, us, 2), 2, "0"))
    digits = F.concat_ws("-", F.left(c, F.lit(4)), F.substr(c, F.lit(5), F.lit(2)), F.substr(c, F.lit(7), F.lit(2)))
    return F.when((F.regexp_extract(c, day, 0) != "") & short.isNotNull(), short).when(c.rlike(us), slashed).when(c.rlike("^[0-9]{8}$"), digits).otherwise(c)


def without_dashes(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def year_of(c: Column) -> Column:
    """The first four characters as a year; null if they aren't a number."""
    return F.left(c, F.lit(4)).try_cast("int")


def period_parts(code: Column) -> Column:
    """struct(year, half, quarter, month) of an eight-place code; null where it has X."""
    part = lambda a, n: F.substr(code, F.lit(a), F.lit(n)).try_cast("int")
    return F.struct(part(1, 4).alias("year"), part(5, 1).alias("half"), part(6, 1).alias("quarter"), part(7, 2).alias("month"))
