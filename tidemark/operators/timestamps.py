"""Mixed timestamp formats and zones to one UTC instant per value."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo, available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import instants

CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
#: Zones by whose names an offset history goes if they share it with others.
USUAL_ZONES = (
    "UTC", "Africa/Nairobi", "Africa/Lagos", "Europe/London", "Europe/Berlin", "America/New_York",
    "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Sao_Paulo", "Asia/Kolkata",
    "Asia/Singapore", "Asia/Tokyo", "Australia/Sydney",
)
QUARTER_US, HOUR_US = 900_000_000, 3_600_000_000


@lru_cache(1)
def offset_histories() -> tuple[str, ...]:
    """One zone for each different history of offsets, day by day, in the years that count."""
    days = [datetime(instants.FIRST_YEAR, 1, 1, tzinfo=UTC) + timedelta(days=d) for d in range(0, 365 * (instants.LAST_YEAR - instants.FIRST_YEAR + 1), 3)]
    by: dict[tuple, str] = {}
    named = [z for z in sorted(available_timezones()) if "/" in z and not z.startswith(("Etc/", "SystemV/", "US/"))]
    for zone in [*USUAL_ZONES, *named]:
        info = ZoneInfo(zone)
        by.setdefault(tuple(d.astimezone(info).utcoffset() for d in days), zone)
    return tuple(sorted(by.values()))


def estimate_zones(pairs: DataFrame, candidates: tuple[str, ...] | None = None, slack_us: int = 0) -> DataFrame:
    """(source, zone, violations, n): the zone whose offset history breaks causality least.

    `pairs` has source, local_us (a wall clock time without zone) and seen_us (the UTC instant at
    which the row was ingested, an upper bound). Under a candidate zone (all `offset_histories` if none are given) an event that lies after its
    ingestion is a violation. Among zones with fewest violations the one with the smallest mean lag
    to ingestion wins, then one of USUAL_ZONES, then the name. As offsets are quarters of hours and change on full ones, a
    source's rows are first folded to their hour and the least offset that keeps them in order, so the
    histories are tried on as many cells as there are hours and offsets, however many rows a source has. Rows with nulls don't count;
    a source without usable pairs gets no row.
    """
    ahead = F.col("local_us") - F.col("seen_us")
    cells = (
        pairs.select("source", "local_us", "seen_us").dropna()
        .groupBy("source", F.floor(F.col("local_us") / HOUR_US).alias("hour"), F.greatest(F.least(F.ceil((ahead - slack_us) / QUARTER_US), F.lit(60)), F.lit(-60)).alias("least"))
        .agg(F.count("*").alias("n"), F.sum(ahead).alias("ahead"))
    )
    named = candidates or offset_histories()
    zones = F.explode(F.array(*[F.struct(F.lit(z not in USUAL_ZONES).alias("unusual"), F.lit(z).alias("zone")) for z in named])).alias("z")
    offset = (F.col("hour") * HOUR_US - instants.to_utc(F.col("hour") * HOUR_US, F.col("zone"))).alias("offset")
    broken = F.col("offset") < F.col("least") * QUARTER_US
    lag = F.col("n") * F.col("offset") - F.col("ahead")
    tried = (
        cells.select("*", zones).select("*", "z.*").withColumn("offset", offset).groupBy("source", "unusual", "zone")
        .agg(F.sum(F.when(broken, F.col("n")).otherwise(0)).alias("violations"), (F.sum(F.abs(lag)) / F.sum("n")).alias("mean_lag"), F.sum("n").alias("n"))
    )
    best = F.min(F.struct("violations", "mean_lag", "unusual", "zone", "n")).alias("b")
    return tried.groupBy("source").agg(best).select("source", "b.zone", "b.violations", "b.n")


def local_pairs(rows: DataFrame, fields: list[str], seen_field: str) -> DataFrame:
    """(source, local_us, seen_us): the values that state no zone, with the instant their row was seen where that is stated.

    `rows` has source, day_first and the text columns. Times at midnight, which most often are dates
    alone, tell nothing about a zone and are left out.
    """
    local = instants.parse(F.col("v"), F.col("day_first"))
    seen = instants.parse(F.col(seen_field), F.col("day_first"))
    return (
        rows.select("source", "day_first", seen_field, F.explode(F.array(*[F.col(f) for f in fields if f != seen_field] or [F.lit(None).cast("string")])).alias("v"))
        .select("source", local.alias("p"), seen.alias("s"))
        .where("p.local_us is not null and p.offset_min is null and p.zone is null and s.offset_min is not null")
        .where(F.col("p.local_us") % instants.DAY_US != 0)
        .select("source", "p.local_us", (F.col("s.local_us") - F.col("s.offset_min").cast("bigint") * 60_000_000).alias("seen_us"))
    )


def normalise_timestamps(
    rows: DataFrame, config: DataFrame, fields: list[str], seen_field: str = "fetched_at",
    candidates: tuple[str, ...] | None = None,
) -> DataFrame:
    """(row_id, field_name, raw, utc_us): one row per non-null value of `fields`.

    `rows` has row_id, source and the text columns; `config` has source, zone, day_first. utc_us is
    -1 for a value that names no real instant in the years 2015 to 2030: empty, words, impossible
    dates, out of range. A zone stated in the value wins, then the source's zone, then the zone
    estimated for sources that state none (see `estimate_zones`), then UTC. Repeated rows give
    repeated results; extra columns are ignored; an empty table gives an empty result. `config` is
    joined on source (one row a source; of several the first by zone counts) and broadcast only if
    Spark finds it small. A null source counts as a source without zone.
    """
    base = rows.select("row_id", F.coalesce("source", F.lit("")).alias("source"), *dict.fromkeys([*fields, seen_field]))
    by_source = config.where("source is not null").groupBy("source").agg(F.min_by("zone", F.coalesce("zone", F.lit("~"))).alias("home"), F.min_by("day_first", F.coalesce("zone", F.lit("~"))).alias("day_first"))
    joined = base.join(by_source, "source", "left")

    pairs = local_pairs(joined.where(F.col("home").isNull()), fields, seen_field)
    guessed = estimate_zones(pairs, candidates).select("source", F.col("zone").alias("guess"))

    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("raw")) for f in fields])).alias("x")
    long = joined.select("row_id", "source", "home", "day_first", values).select("row_id", "source", "home", "day_first", "x.*").where("raw is not null")
    told, untold = long.where("home is not null").withColumn("guess", F.lit(None).cast("string")), long.where("home is null").join(guessed, "source", "left")
    proper = F.create_map(*[F.lit(x) for z in sorted(available_timezones()) for x in (z.lower(), z)])
    home = F.coalesce("home", "guess", F.lit("UTC"))

    def moved(p: Column) -> Column:
        place = F.when(p.zone.isNotNull(), F.try_element_at(proper, p.zone)).otherwise(home)
        return F.when(p.offset_min.isNotNull(), p.local_us - p.offset_min.cast("bigint") * 60_000_000).otherwise(instants.to_utc(p.local_us, place))

    utc = instants.let(instants.parse(F.col("raw"), F.col("day_first")), moved)
    exact = instants.let(utc, lambda u: F.coalesce(F.when(instants.in_range(u), u), F.lit(-1)))
    return told.unionByName(untold).select("row_id", "field_name", "raw", exact.cast("bigint").alias("utc_us"))


def not_canonical(result: DataFrame) -> DataFrame:
    """The rows whose raw value isn't already an in-range `YYYY-MM-DDTHH:MM:SSZ`."""
    return result.where(~F.col("raw").rlike(CANONICAL) | (F.col("utc_us") == -1))
