"""Date expressions between text, epoch seconds and calendar buckets.

None depends on the session time zone: zones are arguments, and buckets go through DATE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.functions.text import SPACE, captures, let, literal_map

_RFC = (
    r"(?i)\A\s*(?:[a-z]+\.?\s*,?\s*)?(\d{1,2})[\s-]+([a-z]{3,9})[\s-]+(\d{2,4})\s+"
    r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?\s*([a-z]+|[+-]\d{1,4})?(?:\s.*)?\z"
)
_GAP = SPACE + "+"
_CLOCK = rf"{_GAP}-{_GAP}(\d{{1,2}}):(\d{{1,2}})\z"
_LISTING = rf"\A(\d{{1,2}}){_GAP}(\p{{L}}+){_GAP}(\d{{4}})({_GAP}року)?{_CLOCK}"
_ISO = r"\A(\d{4})-(\d{1,2})-(\d{1,2})[T ](\d{1,2}):(\d{1,2}):(\d{1,2})\.\d{1,6}\z"


def _number(part: Column) -> Column:
    return part.try_cast("int")


def _epoch(year, month, day, hour, minute, second, zone: Column) -> Column:
    moment = F.try_make_timestamp(year, month, day, hour, minute, second, zone)
    # Second 60 would be taken as the next minute.
    return F.when(second < 60, F.unix_seconds(moment))


def parse_rfc_date(text: Column, tz: str = "UTC") -> Column:
    """RFC 2822 date -> epoch seconds; null if unreadable.

    With no zone, an unknown zone or ``-0000`` the time is local to ``tz``.
    """
    abbreviated = {name[:3]: number for name, number in K.ENGLISH_MONTHS.items()}
    months = literal_map({**K.ENGLISH_MONTHS, **abbreviated})
    zones = literal_map({name: hours * 3600 for name, hours in K.RFC_ZONES.items()})

    def offset(zone: Column, number: Column) -> Column:
        size = F.abs(number)
        numeric = F.signum(number).cast("int") * (F.floor(size / 100) * 3600 + size % 100 * 60)
        unknown = (number == 0) & F.startswith(zone, F.lit("-"))
        return F.coalesce(_number(F.try_element_at(zones, F.upper(zone))), F.when(~unknown, numeric))

    def read(parts: Column) -> Column:
        part = [parts[k] for k in range(7)]
        month = _number(F.try_element_at(months, F.lower(part[1])))
        written = _number(part[2])
        year = written + F.when(written >= 100, 0).when(written > 68, 1900).otherwise(2000)
        second = F.coalesce(_number(part[5]), F.lit(0))
        fields = (year, month, _number(part[0]), _number(part[3]), _number(part[4]), second)
        shift = offset(part[6], _number(part[6]))
        if tz == "UTC":
            moment = _epoch(*fields, F.lit(tz)) - F.coalesce(shift, F.lit(0))
        else:
            moment = let(
                F.coalesce(shift, F.lit(None).cast("bigint")),
                lambda s: _epoch(*fields, F.when(s.isNull(), tz).otherwise("UTC")) - F.coalesce(s, F.lit(0)),
            )
        return F.when(parts.isNotNull(), moment)

    return let(captures(text, _RFC, 7), read).cast("bigint")


def parse_listing_date(text: Column, tz: str = "UTC") -> Column:
    """``13 листопада 2023 року - 20:34`` or ``13 November 2023 - 20:34`` -> epoch seconds, else null."""

    def read(parts: Column) -> Column:
        month = F.when(
            parts[3] == "", F.try_element_at(literal_map(K.ENGLISH_MONTHS), F.lower(parts[1]))
        ).otherwise(F.try_element_at(literal_map(K.UKRAINIAN_MONTHS), parts[1]))
        day, year, hour, minute = (_number(parts[k]) for k in (0, 2, 4, 5))
        return _epoch(year, _number(month), day, hour, minute, F.lit(0), F.lit(tz))

    return let(captures(text, _LISTING, 6), read)


def parse_iso_date(text: Column, tz: str = "UTC") -> Column:
    """ISO time stamp with a fraction, ``T`` or space between -> epoch seconds, else null."""
    return let(captures(text, _ISO, 6), lambda parts: _epoch(*[_number(parts[k]) for k in range(6)], F.lit(tz)))


def utc_date(epoch: Column) -> Column:
    return F.date_from_unix_date(F.floor(epoch / 86400).cast("int"))


def local_date(epoch: Column, tz: str = "UTC") -> Column:
    if tz == "UTC":
        return utc_date(epoch)
    naive = F.timestamp_add("SECOND", epoch, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), naive))


def month_key(epoch: Column, bucket_format: str = "yy-MM") -> Column:
    """UTC month of an epoch second. Two-digit years sort right within one century only."""
    return F.date_format(utc_date(epoch), bucket_format)


def day_key(epoch: Column, tz: str = "UTC") -> Column:
    return F.date_format(local_date(epoch, tz), "yyyy-MM-dd")

