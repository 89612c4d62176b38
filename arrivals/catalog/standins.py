"""Inputs of the star schema, derived from the verification tables."""

from __future__ import annotations

import tempfile
import uuid
from string import Formatter

from pyspark.sql import DataFrame, SparkSession


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL whose tables are written `{lineitem}`."""
    names = {name for _, name, _, _ in Formatter().parse(sql) if name}
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def plain(sql: str) -> str:
    """The same SQL with bare table names."""
    names = {name for _, name, _, _ in Formatter().parse(sql) if name}
    return sql.format(**{n: n for n in names})


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of the cluster; a local one only if none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="arrivals-")
    return f"{shared.rstrip('/')}/arrivals-{uuid.uuid4().hex}/{name}"


# A third of all arrivals use one port.
FACTS = """
    SELECT
        CAST(2015 + l_orderkey % 2 AS DOUBLE) AS i94yr,
        CAST(1 + l_partkey % 4 AS DOUBLE) AS i94mon,
        CAST(l_suppkey % 300 AS DOUBLE) AS i94cit,
        CAST(l_suppkey % 290 AS DOUBLE) AS i94res,
        CASE WHEN l_orderkey % 3 = 0 THEN 'NYC' WHEN l_orderkey % 31 = 1 THEN NULL
             ELSE '0' || CAST(10 + l_partkey % 10 AS VARCHAR(9)) END AS i94port,
        CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE)
             WHEN 2 THEN CAST(-(l_partkey % 800) AS DOUBLE) - 0.5
             WHEN 3 THEN CAST(20000 + l_partkey % 900 AS DOUBLE) + 0.75
             ELSE CAST(20000 + l_partkey % 900 AS DOUBLE) END AS arrdate,
        CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_quantity END AS i94mode,
        CASE WHEN l_partkey % 13 = 0 THEN NULL
             ELSE 'S' || CAST(l_suppkey % 30 AS VARCHAR(9)) END AS i94addr,
        CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(20100 + l_partkey % 900 AS DOUBLE) END AS depdate,
        CAST(l_suppkey % 100 AS DOUBLE) AS i94bir,
        CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS i94visa,
        CAST(l_partkey AS VARCHAR(20)) AS dtadfile,
        'P' || CAST(l_suppkey % 50 AS VARCHAR(9)) AS visapost,
        CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE 'STU' END AS occup,
        l_returnflag AS entdepa,
        l_linestatus AS entdepd,
        CASE WHEN l_orderkey % 19 = 0 THEN 'U' END AS entdepu,
        CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'M' END AS matflag,
        CAST(1915 + l_suppkey % 100 AS DOUBLE) AS biryear,
        'D/S' AS dtaddto,
        CASE WHEN l_partkey % 3 = 0 THEN CAST(l_suppkey AS VARCHAR(20)) END AS insnum,
        CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'AA' ELSE 'DL' END AS airline,
        CAST(l_orderkey AS DOUBLE) * 10 + l_linenumber AS admnum,
        '00' || CAST(l_partkey % 100 AS VARCHAR(9)) AS fltno,
        'B' || CAST(l_linenumber AS VARCHAR(9)) AS visatype
    FROM {lineitem}
"""

# The facts have codes beyond these lists, so that lookups miss.
STATES = """
    SELECT 'S' || CAST(n_nationkey AS VARCHAR(9)) AS state_code, n_name AS state
    FROM {nation}
"""
VISAS = """
    SELECT CAST(r_regionkey AS BIGINT) AS visa_code, r_name AS visa
    FROM {region}
"""
MODES = """
    SELECT CAST(n_nationkey AS BIGINT) AS mode_code, n_name AS mode
    FROM {nation}
"""

# Customers come in pairs; two of three pairs are equal rows. Codes are null, equal or different.
AIRPORTS_RAW = """
    SELECT
        'A' || CAST(g AS VARCHAR(20)) AS airport_id,
        CASE g % 3 WHEN 0 THEN 'heliport' ELSE 'small_airport' END AS type,
        'Field "' || CAST(g % 100 AS VARCHAR(9)) || '", north' AS name,
        CASE WHEN g % 8 = 0 THEN NULL ELSE CAST(g % 9000 AS VARCHAR(9)) END AS elevation_ft,
        'NA' AS continent,
        CASE WHEN g % 4 = 3 THEN 'CA' ELSE 'US' END AS iso_country,
        CASE g % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'US-A-B'
             ELSE 'US-S' || CAST(g % 25 AS VARCHAR(9)) END AS iso_region,
        CASE WHEN g % 5 = 0 THEN NULL ELSE 'Town ' || CAST(g % 70 AS VARCHAR(9)) END AS municipality,
        'K' || CAST(CASE WHEN g % 3 = 0 THEN k ELSE g END AS VARCHAR(20)) AS gps_code,
        CASE WHEN g % 3 = 0 THEN NULL ELSE 'I' || CAST(g AS VARCHAR(20)) END AS iata_code,
        CASE g % 4 WHEN 0 THEN NULL WHEN 1 THEN 'I' || CAST(g AS VARCHAR(20))
             ELSE 'L' || CAST(g AS VARCHAR(20)) END AS local_code,
        CASE g % 10 WHEN 0 THEN 'bad' WHEN 1 THEN '1,' WHEN 2 THEN NULL
             ELSE CAST(g % 90 AS VARCHAR(9)) || '.5, -' || CAST(g % 180 AS VARCHAR(9)) || '.25' END AS coordinates
    FROM (SELECT c_custkey AS k, CAST(floor(c_custkey / 2) AS BIGINT) AS g FROM {customer}) AS pairs
"""

# Text as it stands in the file; some counts are no numbers. Few keys, so many duplicates.
DEMOGRAPHICS_TEXT = """
    SELECT
        'City ' || CAST(o_custkey % 20 AS VARCHAR(9)) AS city,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS state,
        CAST(20 + o_orderkey % 40 AS VARCHAR(9)) || '.5' AS median_age,
        CAST(o_orderkey % 1000 AS VARCHAR(9)) AS male_population,
        CAST(o_orderkey % 900 AS VARCHAR(9)) AS female_population,
        CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR(20)) END AS total_population,
        CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR(20)) END AS number_of_veterans,
        CAST(o_orderkey % 77 AS VARCHAR(9)) AS number_of_foreign_born,
        '2.25' AS average_household_size,
        substr(o_orderpriority, 1, 1) AS state_code,
        o_orderstatus AS race,
        CAST(o_orderkey % 500 AS VARCHAR(9)) AS count
    FROM {orders}
"""

# The same as lines; of some the last two fields are cut off.
_SHORT = "number_of_foreign_born IN ('0', '7', '14')"
DEMOGRAPHICS_LINES = f"""
    SELECT city || ';' || coalesce(state, '') || ';' || median_age || ';' || male_population || ';' || female_population || ';' ||
        total_population || ';' || coalesce(number_of_veterans, '') || ';' || number_of_foreign_born || ';' ||
        average_household_size || ';' || state_code || CASE WHEN {_SHORT} THEN '' ELSE ';' || race || ';' || count END AS value,
        {_SHORT} OR total_population = 'n/a' AS faulty,
        CASE WHEN state IS NULL THEN ',state' ELSE '' END || CASE WHEN total_population = 'n/a' THEN ',total_population' ELSE '' END ||
        CASE WHEN number_of_veterans IS NULL THEN ',number_of_veterans' ELSE '' END || CASE WHEN {_SHORT} THEN ',race,count' ELSE '' END AS empty_columns
    FROM ({DEMOGRAPHICS_TEXT}) AS t
"""

# The same rows after the scan.
DEMOGRAPHICS = f"""
    SELECT city, state, TRY_CAST(median_age AS DOUBLE) AS median_age, male_population, female_population,
        TRY_CAST(total_population AS INTEGER) AS total_population,
        TRY_CAST(number_of_veterans AS INTEGER) AS number_of_veterans,
        TRY_CAST(number_of_foreign_born AS INTEGER) AS number_of_foreign_born,
        TRY_CAST(average_household_size AS DOUBLE) AS average_household_size,
        state_code, race, TRY_CAST(count AS INTEGER) AS count
    FROM ({DEMOGRAPHICS_TEXT}) AS t
"""

# Lines of code lists. A literal tab stands where the lists have one.
COUNTRY_LINES = """
    SELECT '   ' || CAST(c_custkey AS VARCHAR(20)) || CASE c_custkey % 2 WHEN 0 THEN ' =  ' ELSE '  =  ' END ||
        CASE c_custkey % 5 WHEN 0 THEN '''INVALID: ' || c_name || ''''
             WHEN 1 THEN '''No Country Code (' || CAST(c_nationkey AS VARCHAR(9)) || ')'''
             WHEN 2 THEN '''Collapsed ' || c_name || ' (note)'''
             WHEN 3 THEN '''X INVALID ' || c_name || ''''
             ELSE '''' || c_name || ' '' ' END AS value
    FROM {customer}
"""
STATE_LINES = """
    SELECT '\t''K' || CAST(s_suppkey AS VARCHAR(20)) || '''=''' || s_name || ''' ' AS value
    FROM {supplier}
"""
PORT_LINES = """
    SELECT '   ''' || CAST(c_custkey AS VARCHAR(20)) ||
        CASE c_custkey % 7 WHEN 0 THEN '''\t' WHEN 1 THEN ''' ' ELSE '''' END
        || '\t=\t' || '''' || c_mktsegment ||
        CASE c_custkey % 5 WHEN 0 THEN ', ST''' WHEN 1 THEN ', PIER 9, NY   ''' WHEN 2 THEN ',TX   '''
             WHEN 3 THEN ' O''''NEIL,  CA ''' ELSE '''' END AS value
    FROM {customer}
"""
# Pairs for every part, and lines without a pair besides.
VISA_LINES = """
    SELECT '   ' || CAST(p_partkey AS VARCHAR(20)) || ' = ''' || p_name || '''' AS value FROM {part}
    UNION ALL
    SELECT ';' AS value FROM {region}
"""
