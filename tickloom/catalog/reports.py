"""Ridership queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.views import envelopes, ridership, ridership_text
from tickloom.operators import ridership as rid
from tickloom.plans.ridership import land_ridership, read_ridership, report_ridership
from tickloom.sinks.files import land_json
from tickloom.sources.envelope import accepted_envelopes, envelope_rows, read_envelopes
from tickloom.sources.paths import daily_paths
from tickloom.workspace import fresh_path, settle

RUN_DATE = "2024-03-08"
# Rows the service sends in an answer at most.
MOST_ROWS = 1000


def _report_lines(spark, sf_dir):
    usage = rid.usage_by_line_and_station(ridership(spark, sf_dir))
    return rid.report_lines(settle(usage, "usage"))


def _counters(spark, sf_dir):
    return rid.with_counters(ridership_text(spark, sf_dir))


def _sql_view(spark, sf_dir):
    """The line totals as a user's SQL over the rows, seen by that query alone."""
    rows = rid.with_counters(ridership_text(spark, sf_dir))
    return spark.sql(
        """SELECT SBWY_ROUT_LN_NM AS line_name, sum(GTON_TNOPE + GTOFF_TNOPE) AS total_passengers
           FROM {rides} GROUP BY SBWY_ROUT_LN_NM""",
        rides=rows,
    )


def _landed_answers(spark, sf_dir):
    path = fresh_path(spark, "answers")
    envelopes(spark, sf_dir).write.text(path)
    return path


def _api_envelope(spark, sf_dir):
    answers = read_envelopes(spark, _landed_answers(spark, sf_dir), one_per_file=False)
    return rid.with_counters(envelope_rows(answers))


def _answer_files(spark, sf_dir):
    """Answers as the service bounds them: sales of a supplier, at most ``MOST_ROWS`` of
    them. A file holds many answers, one to a line, so that files do not grow in number
    with the answers; files of one answer each are read by the same reader."""
    path = fresh_path(spark, "answers")
    envelopes(spark, sf_dir, by=("l_suppkey",), most=MOST_ROWS).write.text(path)
    return rid.with_counters(envelope_rows(read_envelopes(spark, path, False)))


def _accepted_answers(spark, sf_dir):
    answers = read_envelopes(spark, _landed_answers(spark, sf_dir), one_per_file=False)
    return (
        accepted_envelopes(answers)
        .groupBy(F.col("CardSubwayStatsNew.RESULT.CODE").alias("code"))
        .agg(F.sum("CardSubwayStatsNew.list_total_count").alias("items"))
    )


def _daily_landing(spark, sf_dir):
    """Land the rows of a day and read them back."""
    target = daily_paths(RUN_DATE, fresh_path(spark, "subway")).landing
    land_json(ridership_text(spark, sf_dir), target)
    return read_ridership(spark, target).drop("USE_YMD", "REG_YMD")


ENTRY = "section string, name string, total bigint, boarding bigint, alighting bigint, ratio double"


def _ridership_job(spark, sf_dir):
    """Answers landed, reported on, and the whole report read back."""
    root = fresh_path(spark, "subway")
    land_ridership(spark, _landed_answers(spark, sf_dir), RUN_DATE, root, one_per_file=False)
    written = spark.read.text(report_ridership(spark, RUN_DATE, root))
    return written.select(F.from_json("value", ENTRY).alias("e")).select("e.*")


def _over_ridership(operator):
    return lambda spark, sf_dir: operator(ridership(spark, sf_dir))


QUERIES = {
    "counter_cast": _counters,
    "line_totals": _over_ridership(rid.line_totals),
    "line_totals_sql": _sql_view,
    "station_totals": _over_ridership(rid.station_totals),
    "board_ratio": _over_ridership(rid.board_ratio),
    "ratio_top10": _over_ridership(rid.top_ratio),
    "top5_stations": _over_ridership(rid.top_stations),
    "ridership_report": _report_lines,
    "api_envelope": _api_envelope,
    "api_answer_files": _answer_files,
    "accepted_answers": _accepted_answers,
    "daily_landing": _daily_landing,
    "ridership_job": _ridership_job,
}

_ROWS = """
rides AS (
  SELECT l_returnflag AS line_name, CAST(l_suppkey AS VARCHAR) AS station_name,
         CAST(l_quantity AS BIGINT) AS boarding, CAST(l_linenumber AS BIGINT) AS alighting,
         l_linestatus
  FROM lineitem
), stations AS (
  SELECT station_name, CAST(sum(boarding) AS BIGINT) AS boarding,
         CAST(sum(alighting) AS BIGINT) AS alighting,
         CAST(sum(boarding + alighting) AS BIGINT) AS total
  FROM rides GROUP BY station_name
), lines AS (
  SELECT line_name, CAST(sum(boarding + alighting) AS BIGINT) AS total
  FROM rides GROUP BY line_name
)"""

# Rounds the exact quotient half up, in whole numbers.
_RATIO = "((200 * boarding + alighting) // nullif(2 * alighting, 0)) / 100"

_API_ROWS = """
SELECT line_name AS SBWY_ROUT_LN_NM, station_name AS SBWY_STNS_NM,
       boarding AS GTON_TNOPE, alighting AS GTOFF_TNOPE
FROM rides"""

_API_DAYS = """
SELECT strftime(l_shipdate, '%Y%m%d') AS USE_YMD, l_returnflag AS SBWY_ROUT_LN_NM,
       CAST(l_suppkey AS VARCHAR) AS SBWY_STNS_NM, CAST(l_quantity AS BIGINT) AS GTON_TNOPE,
       CAST(l_linenumber AS BIGINT) AS GTOFF_TNOPE, strftime(l_shipdate, '%Y%m%d') AS REG_YMD
FROM lineitem WHERE l_linestatus <> 'F'"""

_LINE_TOTALS = f"WITH {_ROWS} SELECT line_name, total AS total_passengers FROM lines"

ORACLES = {
    "counter_cast": f"WITH {_ROWS} {_API_ROWS}",
    "line_totals": _LINE_TOTALS,
    "line_totals_sql": _LINE_TOTALS,
    "station_totals": f"""WITH {_ROWS}
        SELECT station_name, boarding AS total_boarding, alighting AS total_alighting
        FROM stations""",
    "board_ratio": f"""WITH {_ROWS}
        SELECT station_name, {_RATIO} AS board_to_alight_ratio FROM stations""",
    "ratio_top10": f"""WITH {_ROWS}
        SELECT station_name, {_RATIO} AS board_to_alight_ratio FROM stations
        ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10""",
    "top5_stations": f"""WITH {_ROWS}
        SELECT station_name, total AS total_usage FROM stations ORDER BY 2 DESC, 1 LIMIT 5""",
    "ridership_report": f"""WITH {_ROWS}
        SELECT 'total_by_line' AS section, line_name AS name, total,
               CAST(NULL AS BIGINT) AS boarding, CAST(NULL AS BIGINT) AS alighting,
               CAST(NULL AS DOUBLE) AS ratio
        FROM lines
        UNION ALL
        SELECT 'station_stats', station_name, NULL, boarding, alighting, NULL FROM stations
        UNION ALL
        (SELECT 'ratio_top10', station_name, NULL, NULL, NULL, {_RATIO} AS r FROM stations
         ORDER BY r DESC NULLS LAST, station_name LIMIT 10)
        UNION ALL
        (SELECT 'top5_stations', station_name, total, NULL, NULL, NULL FROM stations
         ORDER BY total DESC, station_name LIMIT 5)""",
    "api_envelope": _API_DAYS,
    "api_answer_files": _API_DAYS,
    "accepted_answers": """
        SELECT 'INFO-000' AS code, count(*) AS items FROM lineitem WHERE l_linestatus <> 'F'""",
    "daily_landing": f"WITH {_ROWS} {_API_ROWS}",
}

# The report over the rows of accepted answers only.
_ACCEPTED = _ROWS.replace("FROM lineitem", "FROM lineitem WHERE l_linestatus <> 'F'")
ORACLES["ridership_job"] = ORACLES["ridership_report"].replace(_ROWS, _ACCEPTED)
