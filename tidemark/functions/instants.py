"""Text timestamps to UTC instants, with Spark expressions only.

A value is first rewritten by one regular expression per shape into named parts, then turned into
local microseconds by integer arithmetic, then moved to UTC. Nothing depends on the session's zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, three letters each, and zone abbreviations with their offsets in minutes.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
ABBREVIATIONS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120,
    "eet": 120, "eest": 180, "msk": 180, "wat": 60, "cat": 120, "sast": 120, "eat": 180, "ist": 330,
    "sgt": 480, "hkt": 480, "jst": 540, "kst": 540, "awst": 480, "acst": 570, "acdt": 630, "aest": 600,
    "aedt": 660, "nzst": 720, "nzdt": 780, "ast": -240, "adt": -180, "est": -300, "edt": -240,
    "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540,
    "akdt": -480, "hst": -600, "brt": -180, "art": -180,
}

FIRST_YEAR, LAST_YEAR = 2015, 2030
DAY_US = 86_400_000_000
FIRST_US = 1_420_070_400_000_000  # 2015-01-01T00:00:00Z
END_US = 1_924_992_000_000_000  # 2031-01-01T00:00:00Z

CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*([ap]\.?m\.?)?"
TAIL = r"\s*((?:[+-]\d{1,2}(?::?\d{2})?|\[[a-z0-9_+/-]+\]|\(?[a-z]{1,5}\)?)?)$"
MONTH = r"([a-z]{3,9})\.?"
#: shape -> (pattern, replacement giving year|month|day|hour|minute|second|fraction|half|tail)
SHAPES = {
    "iso": (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:[t\s]\s*{CLOCK})?{TAIL}", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    "basic": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[t\s]?(\d{{2}}):?(\d{{2}}):?(?:(\d{{2}})(?:[.,](\d+))?)?())?{TAIL}", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    "day_first": (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}|\d{{2}})(?:[,t\s]\s*{CLOCK})?{TAIL}", "$4|$3|$1|$5|$6|$7|$8|$9|$10"),
    "month_first": (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}|\d{{2}})(?:[,t\s]\s*{CLOCK})?{TAIL}", "$4|$1|$3|$5|$6|$7|$8|$9|$10"),
    "month_day": (rf"^(?:[a-z]{{3,9}},?\s+)?{MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:,?\s+(?:at\s+)?{CLOCK})?{TAIL}", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    "day_month": (rf"^(?:[a-z]{{3,9}},?\s+)?(\d{{1,2}})(?:st|nd|rd|th)?[\s-]+(?:of\s+)?{MONTH},?[\s-]+(\d{{4}}|\d{{2}})(?:,?\s+(?:at\s+)?{CLOCK})?{TAIL}", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
}


def _parts(text: Column, day_first: Column) -> Column:
    """year|month|day|hour|minute|second|fraction|half|tail, or null where no shape fits."""
    put = lambda shape: F.split(F.regexp_replace(text, *SHAPES[shape]), r"\|", -1)
    is_a = lambda shape: text.rlike(SHAPES[shape][0])
    return (
        F.when(is_a("iso"), put("iso"))
        .when(text.rlike(r"^\d{8}(\D|$)|^\d{12}$|^\d{14}$") & is_a("basic"), put("basic"))
        .when(is_a("day_first") & day_first, put("day_first"))
        .when(is_a("month_first"), put("month_first"))
        .when(is_a("month_day"), put("month_day"))
        .when(is_a("day_month"), put("day_month"))
    )


def _number(text: Column) -> Column:
    return F.coalesce(F.when(text.rlike(r"^\d{1,9}$"), text.cast("int")), F.lit(0))


def clean(raw: Column) -> Column:
    """Lower case, without white space (of any kind) and quotes around the value."""
    return F.lower(F.regexp_replace(raw, r"(?U)^[\s ​﻿\"']+|[\s ​﻿\"']+$", ""))


def count_since_epoch(text: Column) -> Column:
    """Microseconds of a plain number: its digits tell seconds, milli-, micro- or nanoseconds."""
    whole = F.regexp_extract(text, r"^(\d{1,19})", 1)
    digits = F.length(whole)
    dec = F.when(text.rlike(r"^\d{1,19}\.\d+$"), F.regexp_extract(text, r"\.(\d+)$", 1)).otherwise(F.lit(""))
    scale = F.when(digits <= 11, 6).when(digits <= 14, 3).when(digits <= 17, 0).otherwise(-3)
    # decimals become further digits; what is finer than a microsecond is cut off
    joined = F.concat(whole, F.rpad(F.substring(dec, 1, 6), 6, "0"))
    kept = F.greatest(F.lit(0), F.least(F.length(joined), digits + scale))
    us = F.when(kept <= 18, F.when(kept > 0, F.substring(joined, F.lit(1), kept)).otherwise(F.lit("0")).cast("bigint"))
    return F.when(text.rlike(r"^\d{1,19}(\.\d+)?$"), us)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then(value)` with `value` computed once a row, however often `then` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _wall_clock(p: Column) -> Column:
    """The numbers in the parts, as one struct; nulls and zeros where they are missing."""
    part = lambda i: F.coalesce(F.get(p, F.lit(i)), F.lit(""))
    names = reduce(lambda c, m: c.when(F.substring(part(1), 1, 3) == m[1], m[0]), enumerate(MONTHS, 1), F.when(part(1) == "", 0))
    return F.struct(
        F.when(F.length(part(0)) == 2, _number(part(0)) + 2000).otherwise(_number(part(0))).alias("year"),
        F.coalesce(F.when(part(1).rlike(r"^\d"), _number(part(1))).otherwise(names), F.lit(0)).alias("month"),
        _number(part(2)).alias("day"), _number(part(3)).alias("hour"), _number(part(4)).alias("minute"), _number(part(5)).alias("second"),
        _number(F.substring(F.rpad(part(6), 6, "0"), 1, 6)).alias("us"), F.substring(part(7), 1, 1).alias("half"),
        part(8).startswith("[").alias("named"), F.regexp_replace(part(8), r"[\[\]()]", "").alias("tail"),
    )


def _local_us(w: Column) -> Column:
    """Microseconds of the wall clock time, null where there is no such date or time."""
    good = (
        w.year.between(FIRST_YEAR - 1, LAST_YEAR + 1) & w.month.between(1, 12) & (w.day >= 1)
        & (w.hour <= 23) & (w.minute <= 59) & (w.second <= 59) & ((w.half == "") | w.hour.between(1, 12))
    )
    hour = F.when(w.half == "p", w.hour % 12 + 12).when(w.half == "a", w.hour % 12).otherwise(w.hour)
    clock = (hour * 3600 + w.minute * 60 + w.second).cast("bigint") * 1_000_000 + w.us
    return let(
        F.when(good, F.make_date(w.year, w.month, F.lit(1))),
        lambda first: F.when(w.day <= F.dayofmonth(F.last_day(first)), (F.unix_date(first) + w.day - 1).cast("bigint") * DAY_US + clock),
    )


def _offset(tail: Column) -> Column:
    """Minutes east of UTC that an offset or abbreviation states, else null."""
    digits = F.regexp_replace(tail, r"\D", "")
    hhmm = F.when(F.length(digits) <= 2, F.concat(F.lpad(digits, 2, "0"), F.lit("00"))).otherwise(F.lpad(digits, 4, "0"))
    minutes = _number(F.substring(hhmm, 1, 2)) * 60 + _number(F.substring(hhmm, 3, 2))
    known = F.create_map(*[F.lit(x) for a in sorted(ABBREVIATIONS.items()) for x in a])
    return F.when(tail.rlike(r"^[+-]\d"), F.when(tail.startswith("-"), -minutes).otherwise(minutes)).otherwise(F.try_element_at(known, tail))


def parse(raw: Column, day_first: Column) -> Column:
    """struct(local_us, offset_min, zone): the wall clock and what the value says about its zone.

    local_us is null for values that name no real wall clock time. A stated offset or abbreviation
    gives offset_min, a stated zone name (in brackets) gives zone; both null means local time. Plain
    numbers that spell no date have offset 0; an unknown abbreviation makes the value unreadable.
    """

    def verdict(w: Column, text: Column) -> Column:
        tail = w.tail
        return let(
            F.struct(_local_us(w).alias("local"), _offset(tail).alias("offset"), count_since_epoch(text).alias("number")),
            lambda x: let(
                x.local.isNotNull() & ((tail == "") | x.offset.isNotNull() | w.named),
                lambda good: F.struct(
                    F.when(good, x.local).otherwise(x.number).alias("local_us"),
                    F.when(good, x.offset).when(x.number.isNotNull(), 0).alias("offset_min"),
                    F.when(good & x.offset.isNull() & (tail != ""), tail).alias("zone"),
                ),
            ),
        )

    first = F.coalesce(day_first, F.lit(True))
    return let(clean(raw), lambda text: let(_parts(text, first), lambda p: let(_wall_clock(p), lambda w: verdict(w, text))))


def in_range(us: Column) -> Column:
    return (us >= FIRST_US) & (us < END_US)


def to_utc(local_us: Column, zone: Column) -> Column:
    """Wall clock microseconds in an IANA zone to UTC microseconds.

    A wall clock time that occurs twice means its first occurrence; a skipped one takes the offset
    before the change.
    """
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_us), zone))


def parse_datetime(raw: Column) -> Column:
    """A timestamp of free-form text: without zone it is UTC; unreadable values and years outside 2015 to 2030 are null."""

    def at(p: Column) -> Column:
        us = p.local_us - F.coalesce(p.offset_min, F.lit(0)).cast("bigint") * 60_000_000
        return F.when(in_range(us) & p.zone.isNull(), F.timestamp_micros(us))

    return let(parse(raw, F.lit(True)), at)


def year_month(at: Column) -> Column:
    """`YYYY-MM` of an instant in UTC; in this form text order is time order."""
    days = F.expr("date '1970-01-01'") + F.floor(F.unix_micros(at) / DAY_US).cast("int")
    return F.date_format(days, "yyyy-MM")
