"""Aggregates over ridership rows (line, station, boarding and alighting counts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE, STATION = "SBWY_ROUT_LN_NM", "SBWY_STNS_NM"
BOARDING, ALIGHTING = "GTON_TNOPE", "GTOFF_TNOPE"


def with_counters(rows: DataFrame) -> DataFrame:
    """Both counters as bigint; unreadable text becomes NULL."""
    return rows.withColumns({name: F.col(name).try_cast("bigint") for name in (BOARDING, ALIGHTING)})


def usage_by_line_and_station(rows: DataFrame) -> DataFrame:
    """The one pass over the rows that all figures of the report are derived from.

    A row with either counter missing adds nothing to ``total``.
    """
    return rows.groupBy(F.col(LINE).alias("line_name"), F.col(STATION).alias("station_name")).agg(
        F.sum(F.col(BOARDING) + F.col(ALIGHTING)).alias("total"),
        F.sum(BOARDING).alias("boarding"),
        F.sum(ALIGHTING).alias("alighting"),
    )


def _ratio(boarding: Column, alighting: Column) -> Column:
    return F.round(F.try_divide(boarding, F.nullif(alighting, F.lit(0))), 2)


def line_totals(rows: DataFrame) -> DataFrame:
    """Passengers per line, busiest first."""
    return (
        rows.groupBy(F.col(LINE).alias("line_name"))
        .agg(F.sum(F.col(BOARDING) + F.col(ALIGHTING)).alias("total_passengers"))
        .orderBy(F.desc("total_passengers"), "line_name")
    )


def station_totals(rows: DataFrame) -> DataFrame:
    """Boarding and alighting per station, most boardings first."""
    return (
        rows.groupBy(F.col(STATION).alias("station_name"))
        .agg(
            F.sum(BOARDING).alias("total_boarding"),
            F.sum(ALIGHTING).alias("total_alighting"),
        )
        .orderBy(F.desc("total_boarding"), "station_name")
    )


def board_ratio(rows: DataFrame) -> DataFrame:
    """Boardings per alighting and station; NULL, sorted last, where nobody alights."""
    return (
        rows.groupBy(F.col(STATION).alias("station_name"))
        .agg(_ratio(F.sum(BOARDING), F.sum(ALIGHTING)).alias("board_to_alight_ratio"))
        .orderBy(F.desc("board_to_alight_ratio"), "station_name")
    )


def top_ratio(rows: DataFrame, n: int = 10) -> DataFrame:
    return board_ratio(rows).limit(n)


def top_stations(rows: DataFrame, n: int = 5) -> DataFrame:
    """The stations with the most passengers; equal totals in order of name."""
    return (
        rows.groupBy(F.col(STATION).alias("station_name"))
        .agg(F.sum(F.col(BOARDING) + F.col(ALIGHTING)).alias("total_usage"))
        .orderBy(F.desc("total_usage"), "station_name")
        .limit(n)
    )


def report_lines(usage: DataFrame, ratios: int = 10, stations: int = 5) -> DataFrame:
    """All four sections of the report from :func:`usage_by_line_and_station`.

    One row per entry, so a report over any number of stations stays distributed.
    Columns that a section does not have are NULL.
    """
    no_count, no_ratio = F.lit(None).cast("bigint"), F.lit(None).cast("double")

    def entries(section, df, name, *, total=no_count, on=no_count, off=no_count, ratio=no_ratio):
        return df.select(
            F.lit(section).alias("section"),
            F.col(name).alias("name"),
            total.alias("total"),
            on.alias("boarding"),
            off.alias("alighting"),
            ratio.alias("ratio"),
        )

    by_line = usage.groupBy("line_name").agg(F.sum("total").alias("total"))
    by_station = usage.groupBy("station_name").agg(
        F.sum("total").alias("total"),
        F.sum("boarding").alias("boarding"),
        F.sum("alighting").alias("alighting"),
    )
    with_ratio = by_station.withColumn("ratio", _ratio(F.col("boarding"), F.col("alighting")))
    by_ratio = with_ratio.orderBy(F.desc("ratio"), "station_name").limit(ratios)
    busiest = by_station.orderBy(F.desc("total"), "station_name").limit(stations)
    return (
        entries("total_by_line", by_line, "line_name", total=F.col("total"))
        .unionByName(
            entries(
                "station_stats",
                by_station,
                "station_name",
                on=F.col("boarding"),
                off=F.col("alighting"),
            )
        )
        .unionByName(entries("ratio_top10", by_ratio, "station_name", ratio=F.col("ratio")))
        .unionByName(entries("top5_stations", busiest, "station_name", total=F.col("total")))
    )


def report_entries(lines: DataFrame, generated_at: str) -> DataFrame:
    """The report as one JSON text per entry, in the column ``entry``: by section, within
    it largest first, missing values last, ties by name. Missing fields are null."""
    value = (
        F.when(F.col("section") == "station_stats", F.col("boarding"))
        .when(F.col("section") == "ratio_top10", F.col("ratio"))
        .otherwise(F.col("total"))
    )
    ordered = lines.orderBy("section", value.desc_nulls_last(), "name")
    stamped = ordered.withColumn("generated_at", F.lit(generated_at))
    return stamped.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("entry"))


def report_document(lines: DataFrame, generated_at: str) -> DataFrame:
    """The report as one JSON text in the column ``document``.

    The whole report becomes one row of one task: for reports over few stations.
    """

    def section(name, order, **fields):
        """Entries of a section, largest first, missing values last, ties by name."""
        value = F.col(order)
        entry = F.struct(
            value.isNull().alias("_last"),
            (-value).alias("_order"),
            F.col("name").alias("_name"),
            F.struct(*(F.col(source).alias(alias) for alias, source in fields.items())).alias("entry"),
        )
        ordered = F.sort_array(F.collect_list(F.when(F.col("section") == name, entry)))
        return F.transform(ordered, lambda item: item["entry"]).alias(name)

    keep_nulls = {"ignoreNullFields": "false"}
    return (
        lines.agg(
            section("total_by_line", "total", line_name="name", total_passengers="total"),
            section(
                "station_stats",
                "boarding",
                station_name="name",
                total_boarding="boarding",
                total_alighting="alighting",
            ),
            section("ratio_top10", "ratio", station_name="name", board_to_alight_ratio="ratio"),
            section("top5_stations", "total", station_name="name", total_usage="total"),
        )
        .withColumn("generated_at", F.lit(generated_at))
        .select(F.to_json(F.struct("*"), keep_nulls).alias("document"))
    )
