"""P1 daily metrics: ratios, group peaks, global totals and running totals
over two joined daily tables (FLT1, FLT3, PRJ1-3, AGG1-3, WIN1, JN1,
SRT1-2, NUM3, SINK3-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cast_int, percent
from ..operators import aggregates as agg
from ..operators import joins, relational as rel
from ..operators.windows import running_total
from ..sources.io import materialize, publish_view
from .catalog import query, table

CASES, DOSES = "daily_cases", "daily_doses"
PATTERN = "nation_1"


def cases(spark, sf) -> DataFrame:
    return table(spark, sf, CASES)


def reported(spark, sf) -> DataFrame:
    """Rows of locations that belong to a continent (the aggregate rows of
    the source have none)."""
    return rel.where_not_null(cases(spark, sf), "continent")


def rolling_vaccinations(spark, sf) -> DataFrame:
    """Join → filter → running total per location (C:82-89).

    The continent filter touches the case table only, so Catalyst applies it
    below the join; the join holds one row per (location, date), so the
    running total is one window over it."""
    dea = reported(spark, sf).select("continent", "location", "date", "population")
    vac = table(spark, sf, DOSES).select("location", "date", "new_vaccinations")
    j = joins.join_daily(dea, vac)
    out = running_total(j, "location", ["location", "date"], "new_vaccinations",
                        "RollingPeopleVaccinated", one_row_per_key=True)
    return out.select("continent", "location", "date", "population", "new_vaccinations",
                      F.col("RollingPeopleVaccinated").cast("bigint").alias("RollingPeopleVaccinated"))


def percent_rolling(spark, sf) -> DataFrame:
    """The CTE form with the percentage of the population (C:94-106)."""
    r = rolling_vaccinations(spark, sf)
    return r.withColumn("PercentRollingPeopleVaccinated",
                        percent("RollingPeopleVaccinated", "population"))


_ROLLING_SQL = """
SELECT dea.continent, dea.location, dea.date, dea.population, vac.new_vaccinations,
       CAST(SUM(TRY_CAST(vac.new_vaccinations AS INT))
            OVER (PARTITION BY dea.location ORDER BY dea.location, dea.date) AS BIGINT)
         AS RollingPeopleVaccinated
FROM daily_cases dea JOIN daily_doses vac
  ON dea.location = vac.location AND dea.date = vac.date
WHERE dea.continent IS NOT NULL
"""


@query("flt1_where_not_null", "SELECT * FROM daily_cases WHERE continent IS NOT NULL",
       uses=[CASES])
def flt1(spark, sf):
    return reported(spark, sf)


@query("srt1_order_by_ordinals",
       "SELECT * FROM daily_cases WHERE continent IS NOT NULL ORDER BY 3, 4", uses=[CASES])
def srt1(spark, sf):
    """C:1-4: ``order by 3,4`` — a range-partitioned distributed sort."""
    d = reported(spark, sf)
    return rel.order_by(d, d.columns[2], d.columns[3])


@query("prj1_select_columns", """
SELECT location, date, total_cases, new_cases, total_deaths, population
FROM daily_cases WHERE continent IS NOT NULL""", uses=[CASES])
def prj1(spark, sf):
    return reported(spark, sf).select("location", "date", "total_cases", "new_cases",
                                      "total_deaths", "population")


@query("flt3_like_case_insensitive", f"""
SELECT location, date, total_cases, total_deaths,
       TRY_CAST(total_deaths AS DOUBLE) / total_cases * 100 AS DeathPercentage
FROM daily_cases WHERE contains(lower(location), lower('{PATTERN}')) AND continent IS NOT NULL""", uses=[CASES])
def flt3(spark, sf):
    d = rel.where_contains_ci(reported(spark, sf), "location", PATTERN)
    return d.select("location", "date", "total_cases", "total_deaths",
                    percent("total_deaths", "total_cases").alias("DeathPercentage"))


@query("prj2_derived_ratio", """
SELECT location, date, population, total_cases,
       total_cases / population * 100 AS PercentPopulationInfected
FROM daily_cases WHERE continent IS NOT NULL""", uses=[CASES])
def prj2(spark, sf):
    d = reported(spark, sf).select("location", "date", "population", "total_cases")
    return rel.with_ratio(d, "total_cases", "population", "PercentPopulationInfected")


@query("prj3_percent_text_operands", """
SELECT location, date, total_deaths, new_deaths,
       TRY_CAST(new_deaths AS DOUBLE) / TRY_CAST(total_deaths AS DOUBLE) * 100 AS pct
FROM daily_cases WHERE continent IS NOT NULL""", uses=[CASES])
def prj3(spark, sf):
    """Percent of two text columns; a zero denominator gives null."""
    d = reported(spark, sf)
    return d.select("location", "date", "total_deaths", "new_deaths",
                    percent("new_deaths", "total_deaths").alias("pct"))


@query("agg1_peak_ratio", """
SELECT location, population, MAX(total_cases) AS HighestInfectionCount,
       MAX(total_cases / population) * 100 AS MaxPercentPopulationInfected
FROM daily_cases WHERE continent IS NOT NULL GROUP BY location, population""", uses=[CASES])
def agg1(spark, sf):
    d = reported(spark, sf)
    return agg.peak_ratio(d, ["location", "population"], "total_cases", "population",
                          "HighestInfectionCount", "MaxPercentPopulationInfected")


@query("srt2_order_desc", """
SELECT location, population, MAX(total_cases) AS HighestInfectionCount,
       MAX(total_cases / population) * 100 AS MaxPercentPopulationInfected
FROM daily_cases WHERE continent IS NOT NULL GROUP BY location, population
ORDER BY 4 DESC""", uses=[CASES])
def srt2(spark, sf):
    return agg1(spark, sf).orderBy(F.col("MaxPercentPopulationInfected").desc())


@query("agg2_peak_count_location", """
SELECT location, MAX(TRY_CAST(total_deaths AS INT)) AS TotalDeathCount
FROM daily_cases WHERE continent IS NOT NULL GROUP BY location ORDER BY 2 DESC""", uses=[CASES])
def agg2(spark, sf):
    return agg.peak_count(reported(spark, sf), "location", "total_deaths", "TotalDeathCount") \
        .orderBy(F.col("TotalDeathCount").desc())


@query("agg2_peak_count_continent", """
SELECT continent, MAX(TRY_CAST(total_deaths AS INT)) AS TotalDeathCount
FROM daily_cases WHERE continent IS NOT NULL GROUP BY continent ORDER BY 2 DESC""", uses=[CASES])
def agg2c(spark, sf):
    return agg.peak_count(reported(spark, sf), "continent", "total_deaths", "TotalDeathCount") \
        .orderBy(F.col("TotalDeathCount").desc())


@query("agg3_global_totals", """
SELECT SUM(new_cases) AS total_cases,
       CAST(SUM(TRY_CAST(new_deaths AS INT)) AS BIGINT) AS total_deaths,
       CAST(SUM(TRY_CAST(new_deaths AS INT)) AS DOUBLE) / SUM(new_cases) * 100 AS DeathPercentage
FROM daily_cases WHERE continent IS NOT NULL""", uses=[CASES])
def agg3(spark, sf):
    return agg.global_totals(reported(spark, sf), "new_cases", "new_deaths")


@query("num3_cast_int", """
SELECT location, date, TRY_CAST(new_vaccinations AS INT) AS new_vaccinations_int
FROM daily_doses""", uses=[DOSES])
def num3(spark, sf):
    return table(spark, sf, DOSES).select(
        "location", "date", cast_int("new_vaccinations").alias("new_vaccinations_int"))


@query("jn1_join_daily", """
SELECT dea.location, dea.date, dea.new_cases, vac.new_vaccinations
FROM daily_cases dea JOIN daily_doses vac ON dea.location = vac.location AND dea.date = vac.date""",
       uses=[CASES, DOSES])
def jn1(spark, sf):
    dea = cases(spark, sf).select("location", "date", "new_cases")
    vac = table(spark, sf, DOSES).select("location", "date", "new_vaccinations")
    return joins.join_daily(dea, vac)


@query("win1_running_total", _ROLLING_SQL, uses=[CASES, DOSES])
def win1(spark, sf):
    return rolling_vaccinations(spark, sf)


@query("p1_percent_rolling_cte", f"""
, pv AS ({_ROLLING_SQL})
SELECT *, RollingPeopleVaccinated / population * 100 AS PercentRollingPeopleVaccinated FROM pv
""", uses=[CASES, DOSES])
def p1_cte(spark, sf):
    return percent_rolling(spark, sf)


TEMP_SCHEMA = ("Continent string, Location string, Date timestamp_ntz, Population decimal(18,0), "
               "New_vaccinations decimal(18,0), RollingPeopleVaccinated decimal(18,0)")


@query("sink3_temp_table", f"""
, pv AS ({_ROLLING_SQL}),
t AS (SELECT continent AS Continent, location AS Location, CAST(date AS TIMESTAMP) AS Date,
             CAST(population AS DECIMAL(18,0)) AS Population,
             CAST(new_vaccinations AS DECIMAL(18,0)) AS New_vaccinations,
             CAST(RollingPeopleVaccinated AS DECIMAL(18,0)) AS RollingPeopleVaccinated FROM pv)
SELECT Continent, Location, Date, CAST(Population AS DOUBLE) AS Population,
       CAST(New_vaccinations AS DOUBLE) AS New_vaccinations,
       CAST(RollingPeopleVaccinated AS DOUBLE) AS RollingPeopleVaccinated,
       CAST(RollingPeopleVaccinated AS DOUBLE) / CAST(Population AS DOUBLE) * 100
         AS PercentRollingPeopleVaccinated
FROM t""", uses=[CASES, DOSES])
def sink3(spark, sf):
    """C:112-135: declared column types (numeric = decimal(18,0)), stored,
    read back; percent over the stored decimals."""
    t = materialize(rolling_vaccinations(spark, sf), "PercentPopulationVaccinated_tmp", TEMP_SCHEMA)
    pct = t["RollingPeopleVaccinated"].cast("double") / t["Population"].cast("double") * 100
    return t.select(
        "Continent", "Location", "Date",
        *[F.col(c).cast("double").alias(c) for c in
          ("Population", "New_vaccinations", "RollingPeopleVaccinated")],
        pct.alias("PercentRollingPeopleVaccinated"))


@query("sink4_view", _ROLLING_SQL, uses=[CASES, DOSES])
def sink4(spark, sf):
    publish_view(rolling_vaccinations(spark, sf), "PercentPopulationVaccinated")
    return spark.sql("SELECT * FROM PercentPopulationVaccinated")
