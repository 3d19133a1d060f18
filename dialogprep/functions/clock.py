"""Clock text in a local time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone of the clock, the abbreviations by UTC offset in hours, and the place.
ZONE = "America/Denver"
ABBREVIATIONS = {-7: "MST", -6: "MDT"}
PLACE = "Bozeman"


def utc_offset_seconds(ts: Column, zone: str = ZONE) -> Column:
    return F.unix_timestamp(F.from_utc_timestamp(ts, zone)) - F.unix_timestamp(ts)


def iso_local(ts: Column, zone: str = ZONE) -> Column:
    """ISO text with offset; microseconds appear only when there are any."""
    local = F.from_utc_timestamp(ts, zone)
    offset = utc_offset_seconds(ts, zone)
    hours = F.abs(offset) / 3600
    minutes = F.abs(offset) % 3600 / 60
    micros = F.date_format(local, "SSSSSS")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""),
        F.when(offset < 0, "-").otherwise("+"),
        F.lpad(F.floor(hours).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.floor(minutes).cast("string"), 2, "0"),
    )


def watch_text(ts: Column, zone: str = ZONE, abbreviations: dict[int, str] = ABBREVIATIONS, place: str = PLACE) -> Column:
    """``struct(message, timestamp)`` for the time ``ts`` (UTC)."""
    local = F.from_utc_timestamp(ts, zone)
    short = F.lit(zone)
    for hours, name in abbreviations.items():
        short = F.when(utc_offset_seconds(ts, zone) == hours * 3600, F.lit(name)).otherwise(short)
    friendly = F.concat(F.date_format(local, "EEEE, MMMM dd, yyyy 'at' hh:mm a "), short)
    return F.struct(
        F.concat(F.lit("It's currently "), friendly, F.lit(f" ({place} time).")).alias("message"),
        iso_local(ts, zone).alias("timestamp"),
    )
