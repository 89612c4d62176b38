"""Date decoding, lookups, the conformed facts, and the whole load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.catalog import standins as s
from arrivals.catalog.tables import AIRPORTS_SQL, DEMOGRAPHICS_SQL
from arrivals.functions import sas_date
from arrivals.operators import Codes, dimension, lookup
from arrivals.plans import ArrivalDimensions, StarInputs, conform_arrivals, load_star


def dimensions(spark: SparkSession, sf_dir: str) -> ArrivalDimensions:
    return ArrivalDimensions.of(
        us_state=s.derive(spark, sf_dir, s.STATES),
        visa=s.derive(spark, sf_dir, s.VISAS),
        mode=s.derive(spark, sf_dir, s.MODES),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed facts of the stand-in."""
    return conform_arrivals(s.derive(spark, sf_dir, s.FACTS), dimensions(spark, sf_dir))


def sas_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = s.derive(spark, sf_dir, s.FACTS)
    return facts.select("admnum", "arrdate", sas_date(F.col("arrdate")).alias("arrival_date"))


def lookup_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lookup by a numeric code; the dimension is measured, then broadcast."""
    visa = dimension(Codes(s.derive(spark, sf_dir, s.VISAS), "visa_code", "visa", numeric=True))
    facts = s.derive(spark, sf_dir, s.FACTS).select("admnum", "i94visa")
    return lookup(facts, visa, "i94visa", "visa_type_code", "Other")


def lookup_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup in a dimension that grows with the data: no broadcast hint, Spark picks the join."""
    names = s.derive(spark, sf_dir, "SELECT p_partkey, p_name FROM {part}")
    parts = dimension(Codes(names, "p_partkey", "p_name", numeric=True), broadcast_bytes=0)
    facts = s.derive(
        spark,
        sf_dir,
        """SELECT l_orderkey, l_linenumber, CASE l_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN -l_partkey ELSE l_partkey END AS part
           FROM {lineitem}""",
    )
    return lookup(facts, parts, "part", "part_name", "unknown")


def star_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All inputs written as files, then the whole load; the result is its report."""
    root = s.scratch(spark, "inputs")
    inputs = StarInputs(
        countries=f"{root}/countries.txt",
        us_states=f"{root}/states.txt",
        us_ports=f"{root}/ports.txt",
        visas=f"{root}/visas.txt",
        modes=f"{root}/modes.txt",
        airports=f"{root}/airports.csv",
        demographics=f"{root}/demographics.csv",
        facts=f"{root}/facts",
    )
    for path, sql in (
        (inputs.countries, s.COUNTRY_LINES),
        (inputs.us_states, f"SELECT '\t''' || state_code || '''=''' || state || '''' AS value FROM ({s.STATES}) AS t"),
        (inputs.us_ports, s.PORT_LINES),
        (inputs.visas, f"SELECT visa_code || ' = ''' || visa || '''' AS value FROM ({s.VISAS}) AS t"),
        (inputs.modes, f"SELECT mode_code || ' = ''' || mode || '''' AS value FROM ({s.MODES}) AS t"),
    ):
        s.derive(spark, sf_dir, sql).write.text(path)
    s.derive(spark, sf_dir, s.AIRPORTS_RAW).write.csv(inputs.airports, header=True)
    s.derive(spark, sf_dir, s.DEMOGRAPHICS_TEXT).write.csv(inputs.demographics, header=True, sep=";")
    s.derive(spark, sf_dir, s.FACTS).write.parquet(inputs.facts)
    return load_star(spark, inputs, s.scratch(spark, "star"))


QUERIES = {
    "sas_date": sas_dates,
    "lookup_one": lookup_one,
    "lookup_large": lookup_large,
    "lookup_star": arrivals,
    "star_load": star_load,
}

_FACTS = s.plain(s.FACTS)
_STATES = s.plain(s.STATES)
_VISAS = s.plain(s.VISAS)
_MODES = s.plain(s.MODES)

_DATE = """
    CASE WHEN arrdate <> 0 THEN strftime(DATE '1960-01-01' + CAST(floor(arrdate) AS INTEGER), '%Y-%m-%d') END
"""

# The columns are fixed values. A lookup is a scalar subquery, which fails if a code is listed twice.


def arrivals_sql(facts: str) -> str:
    """Conformed arrivals of any facts."""
    return f"""
    WITH facts AS (FROM ({facts})), states AS (FROM ({_STATES})), visas AS (FROM ({_VISAS})), modes AS (FROM ({_MODES}))
    SELECT
        i94yr AS year,
        i94mon AS month,
        i94cit AS birth_country,
        i94res AS residence_country,
        i94port AS port,
        {_DATE} AS arrival_date,
        ifnull((SELECT mode FROM modes WHERE mode_code = i94mode), 'Not reported') AS arrival_mode,
        ifnull((SELECT state_code FROM states WHERE state_code = i94addr), '99') AS us_state,
        depdate AS departure_date,
        i94bir AS repondent_age,
        ifnull((SELECT visa FROM visas WHERE visa_code = i94visa), 'Other') AS visa_type_code,
        dtadfile AS date_added,
        visapost AS visa_issued_department,
        occup AS occupation,
        entdepa AS arrival_flag,
        entdepd AS departure_flag,
        entdepu AS update_flag,
        matflag AS match_arrival_departure_fag,
        biryear AS birth_year,
        dtaddto AS allowed_date,
        insnum AS ins_number,
        airline,
        admnum AS admission_number,
        fltno AS flight_number,
        visatype AS visa_type
    FROM facts
"""


ARRIVALS_SQL = arrivals_sql(_FACTS)

SQL = {
    "sas_date": f"SELECT admnum, arrdate, {_DATE} AS arrival_date FROM ({_FACTS}) AS f",
    "lookup_one": f"""
        SELECT admnum, i94visa, coalesce(visa, 'Other') AS visa_type_code
        FROM ({_FACTS}) AS f LEFT JOIN ({_VISAS}) AS v ON f.i94visa = v.visa_code
    """,
    "lookup_large": """
        SELECT l_orderkey, l_linenumber, part, coalesce(p_name, 'unknown') AS part_name
        FROM (SELECT l_orderkey, l_linenumber, CASE l_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN -l_partkey ELSE l_partkey END AS part
              FROM lineitem) AS f
        LEFT JOIN part ON f.part = p_partkey
    """,
    "lookup_star": ARRIVALS_SQL,
    "star_load": f"""
        SELECT 'countries' AS dataset, count(*) AS rows_in, count(*) AS rows_out FROM customer
        UNION ALL
        SELECT 'us_states', count(*), count(*) FROM ({_STATES}) AS t
        UNION ALL
        SELECT 'us_ports', count(*), count(*) FROM customer
        UNION ALL
        SELECT 'us_airports',
            (SELECT count(*) FROM (SELECT DISTINCT * FROM ({s.plain(s.AIRPORTS_RAW)}) AS r) AS d),
            (SELECT count(*) FROM ({AIRPORTS_SQL}) AS a)
        UNION ALL
        SELECT 'us_cities_demographics', (SELECT count(*) FROM orders), (SELECT count(*) FROM ({DEMOGRAPHICS_SQL}) AS d)
        UNION ALL
        SELECT 'immigration_data', count(*), count(*) FROM lineitem
        UNION ALL
        SELECT 'us_airports lines', count(*), count(*) FROM customer
        UNION ALL
        SELECT 'us_cities_demographics lines', count(*), count(*) FILTER (total_population <> 'n/a') FROM ({s.plain(s.DEMOGRAPHICS_TEXT)}) AS t
        UNION ALL
        SELECT 'typed facts', count(*), count(*) FROM lineitem
        UNION ALL
        SELECT 'state lookups', count(*), count(*) FILTER (i94addr IN (SELECT state_code FROM ({_STATES}) AS t)) FROM ({_FACTS}) AS f
        UNION ALL
        SELECT 'visa lookups', count(*), count(*) FILTER (i94visa IN (SELECT visa_code FROM ({_VISAS}) AS t)) FROM ({_FACTS}) AS f
        UNION ALL
        SELECT 'mode lookups', count(*), count(*) FILTER (i94mode IN (SELECT mode_code FROM ({_MODES}) AS t)) FROM ({_FACTS}) AS f
        UNION ALL
        SELECT 'arrival dates', count(*) FILTER (arrdate <> 0), count({_DATE}) FROM ({_FACTS}) AS f
        UNION ALL
        SELECT 'visas', count(*), count(*) FROM ({_VISAS}) AS v
        UNION ALL
        SELECT 'modes', count(*), count(*) FROM ({_MODES}) AS m
    """,
}
