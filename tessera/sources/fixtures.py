"""Views that give the driver's base tables the shapes the analyses read.

The analyses were written against tables that are not shipped (daily case
and vaccination tables, a property-sales table, two review exports, a car
list and a customer file).  Each view below derives such a table from the
base tables, over all of their rows.  The same SQL text serves Spark and the
DuckDB oracle; the few spots where the dialects differ are ``{placeholders}``
filled per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

DIALECT = {
    "spark": {
        # duplicate every urgent order once: a generator, not a filter
        "copies": "explode(CASE WHEN o.o_orderpriority = '1-URGENT' "
                  "THEN array(0, 1) ELSE array(0) END)",
        "ts": "TIMESTAMP_NTZ",
    },
    "duckdb": {
        "copies": "unnest(CASE WHEN o.o_orderpriority = '1-URGENT' "
                  "THEN [0, 1] ELSE [0] END)",
        "ts": "TIMESTAMP",
    },
}

SQL = {}

SQL["daily_cases"] = """
WITH d AS (
  SELECT n.n_name AS location,
         CASE WHEN r.r_name = 'ASIA' THEN NULL ELSE r.r_name END AS continent,
         CAST(o.o_orderdate AS DATE) AS date,
         CAST(COUNT(*) AS DOUBLE) AS new_cases,
         CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS INT) AS nd
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY n.n_name, r.r_name, CAST(o.o_orderdate AS DATE)),
p AS (
  SELECT n.n_name AS location, CAST(COUNT(*) * 1000 AS DOUBLE) AS population
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name)
SELECT d.location, d.continent, d.date, p.population,
       SUM(d.new_cases) OVER (PARTITION BY d.location ORDER BY d.date) AS total_cases,
       d.new_cases,
       CAST(SUM(d.nd) OVER (PARTITION BY d.location ORDER BY d.date) AS STRING) AS total_deaths,
       CAST(d.nd AS STRING) AS new_deaths
FROM d JOIN p ON d.location = p.location
"""

SQL["daily_doses"] = """
SELECT n.n_name AS location, CAST(l.l_shipdate AS DATE) AS date,
       CASE WHEN COUNT(*) % 3 = 0 THEN NULL
            ELSE CAST(CAST(SUM(l.l_quantity) AS INT) AS STRING) END AS new_vaccinations
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name, CAST(l.l_shipdate AS DATE)
"""

SQL["parcels"] = """
WITH u AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_totalprice,
         o.o_orderdate, o.o_orderpriority, c.c_mktsegment, n.n_name, r.r_name,
         {copies} AS bump
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT CAST(k + bump * 1000000000 AS BIGINT) AS UniqueID,
       CAST(o_custkey AS STRING) AS ParcelID,
       CASE WHEN k % 5 = 0 THEN NULL
            ELSE concat(CAST(o_custkey AS STRING), ' ', c_mktsegment, ' ST, ', n_name) END AS PropertyAddress,
       CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN concat(n_name, ', ', r_name)
            ELSE concat(CAST(o_custkey AS STRING), ' ', c_mktsegment, ' ST, ', n_name, ', ', r_name) END AS OwnerAddress,
       CAST(o_orderdate AS {ts}) AS SaleDate, o_totalprice AS SalePrice, o_orderpriority AS LegalReference,
       CASE WHEN o_orderstatus = 'F' THEN 'Y' WHEN o_orderstatus = 'O' THEN 'N'
            WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS SoldAsVacant,
       c_mktsegment AS TaxDistrict
FROM u
"""

# First review export (no dates).  Every document is a review; the rating
# text carries one decimal, is missing for some rows.
SQL["reviews_a"] = """
SELECT concat('http://example.com/a/', CAST(doc_id AS STRING)) AS url, source AS Restaurant,
       CASE doc_id % 4 WHEN 0 THEN 'Jalan 1, Kuala Lumpur' WHEN 1 THEN 'Penang Road'
                       WHEN 2 THEN 'Old Town, Ipoh' ELSE 'Elsewhere' END AS Location,
       CASE WHEN doc_id % 50 = 7 THEN NULL
            ELSE concat('Rated ', CAST(1 + doc_id % 5 AS STRING), '.5 of 5') END AS Rating,
       text AS Review
FROM documents
"""

# Second review export (with relative dates).  Every document again, rated
# differently: where both ratings agree the two exports hold the same review
# (the planted duplicates); ratings without decimals do not parse.
SQL["reviews_b"] = """
SELECT concat('http://example.com/b/', CAST(doc_id AS STRING)) AS url, source AS Restaurant,
       CASE doc_id % 4 WHEN 0 THEN 'Jalan 1, Kuala Lumpur' WHEN 1 THEN 'Penang Road'
                       WHEN 2 THEN 'Old Town, Ipoh' ELSE 'Elsewhere' END AS Location,
       CASE WHEN doc_id % 50 = 7 THEN NULL
            WHEN doc_id % 50 = 11 THEN 'Rated 4 of 5'
            ELSE concat('Rated ', CAST(1 + (doc_id * 3) % 5 AS STRING), '.0 of 5') END AS Rating,
       text AS Review,
       CASE doc_id % 7
         WHEN 0 THEN concat('Reviewed ', CAST(1 + doc_id % 4 AS STRING), ' weeks ago')
         WHEN 1 THEN concat('Reviewed ', CAST(1 + doc_id % 6 AS STRING), ' days ago')
         WHEN 2 THEN 'Reviewed yesterday'
         WHEN 3 THEN 'Reviewed today'
         ELSE concat('Reviewed ', CAST(1 + doc_id % 28 AS STRING), ' ',
                     CASE doc_id % 3 WHEN 0 THEN 'March' WHEN 1 THEN 'July' ELSE 'November' END,
                     ' ', CAST(2015 + doc_id % 4 AS STRING)) END AS Dates
FROM documents
"""

SQL["cars"] = """
SELECT CAST(p_partkey AS STRING) AS CarID, p_brand AS Brand, p_type AS Type, p_name AS PlateNum,
       concat('RM', CAST(100 + p_size * 10 AS STRING)) AS PricePerDay
FROM part
"""

SQL["rentals"] = """
SELECT CAST(c_custkey AS STRING) AS CustID, c_name AS Name,
       concat('No. ', CAST(c_custkey AS STRING), ', Example Street') AS Address,
       concat('555-', CAST(1000000 + c_custkey AS STRING)) AS Phone,
       concat('IC-', CAST(500000 + c_custkey AS STRING)) AS ICNo,
       concat(CASE WHEN c_custkey % 2 = 0 THEN 'RM' ELSE 'RM ' END,
              CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS STRING)) AS Balance,
       CAST(DATE '2024-01-01' + CAST(c_custkey % 300 AS INT) AS STRING) AS Startdate,
       CAST(DATE '2024-01-01' + CAST(c_custkey % 300 + c_custkey % 9 AS INT) AS STRING) AS Enddate,
       CAST(c_custkey % 200 AS STRING) AS CarID
FROM customer
"""

SQL["payment_requests"] = """
SELECT CAST(c_custkey AS STRING) AS CustID, CAST(1 + c_custkey % 6 AS INT) AS choice,
       CAST(1 + c_custkey % 7 AS INT) AS provider_choice,
       CASE WHEN c_custkey % 8 = 0 THEN '4000 0000 0000 000' WHEN c_custkey % 9 = 0 THEN NULL
            WHEN c_custkey % 10 = 0 THEN '  ' ELSE '4000 0000 0000 0002' END AS card_no,
       CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN ''
            WHEN c_custkey % 4 = 0 THEN '0125' WHEN c_custkey % 5 = 1 THEN '1324'
            WHEN c_custkey % 5 = 2 THEN '12/30' WHEN c_custkey % 5 = 3 THEN '0324'
            ELSE '0630' END AS expiry,
       CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN ''
            WHEN c_custkey % 7 = 0 THEN '012' ELSE '345' END AS cvv,
       'secret' AS password
FROM customer
"""

# Every order is a request to rent a car; a third of them come from one
# customer.
SQL["rental_requests"] = """
SELECT o_orderkey AS RequestID,
       CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE CAST(o_custkey AS STRING) END AS CustID,
       CAST(o_orderdate AS DATE) AS requested_on, CAST(1 + o_orderkey % 4 AS INT) AS choice,
       CAST(1 + o_custkey % 6 AS INT) AS provider_choice, CAST(o_orderkey % 200 AS STRING) AS CarID,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS Startdate,
       CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INT) AS STRING) AS Enddate
FROM orders
"""

FIXTURES = tuple(SQL)


def fixture_sql(name: str, engine: str) -> str:
    return SQL[name].format(**DIALECT[engine]).strip()


_REGISTERED: dict = {}


def register_base_tables(spark: SparkSession, sf_dir: str) -> None:
    """Register the base tables of ``sf_dir`` as temp views (once per session
    and folder; re-registered when the folder changes or a view is gone)."""
    key = id(spark)
    if _REGISTERED.get(key) == sf_dir and all(spark.catalog.tableExists(t) for t in BASE_TABLES):
        return
    for t in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    _REGISTERED[key] = sf_dir


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a fixture view as a DataFrame (lazy, nothing runs)."""
    register_base_tables(spark, sf_dir)
    if name in BASE_TABLES:
        return spark.table(name)
    return spark.sql(fixture_sql(name, "spark"))


def oracle_with(*names: str) -> str:
    """``WITH`` clause inlining fixture views for the DuckDB oracle."""
    parts = [f"{n} AS (\n{fixture_sql(n, 'duckdb')}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
