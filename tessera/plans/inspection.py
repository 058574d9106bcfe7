"""Scans and inspection of tables: full scan, CSV round trip, first/last
rows, ``describe`` and ``info`` profiles (SRC1-2, PRF1-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, relational as rel
from ..session import scratch_path
from ..sources.io import read_reviews_csv, read_table, write_reviews_csv
from .catalog import query, table

REVIEW_SCHEMA = "url string, Restaurant string, Location string, Rating string, Review string"


@query("src1_read_table", "SELECT * FROM orders")
def src1(spark, sf):
    return read_table(spark, f"{sf}/orders.parquet")


@query("src2_read_reviews_csv", "SELECT url, Restaurant, Location, Rating, Review FROM reviews_a",
       uses=["reviews_a"])
def src2(spark, sf):
    """The first review export written as CSV (quotes and line breaks in the
    text) and read back with an explicit schema."""
    path = scratch_path(spark, "reviews_csv")
    write_reviews_csv(table(spark, sf, "reviews_a"), path)
    return read_reviews_csv(spark, path, REVIEW_SCHEMA)


@query("prf1_first_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def prf1(spark, sf):
    return rel.first_rows(table(spark, sf, "orders"), ["o_orderkey"], 5)


@query("prf2_last_rows", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def prf2(spark, sf):
    return rel.last_rows(table(spark, sf, "orders"), ["o_orderkey"], 5)


_SPARK_TYPES = [("UniqueID", "bigint"), ("ParcelID", "string"), ("PropertyAddress", "string"),
                ("OwnerAddress", "string"), ("SaleDate", "timestamp_ntz"),
                ("SalePrice", "double"), ("LegalReference", "string"),
                ("SoldAsVacant", "string"), ("TaxDistrict", "string")]


@query("prf4_schema_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column, '{t}' AS type, CAST(COUNT({c}) AS BIGINT) AS non_null FROM parcels"
    for c, t in _SPARK_TYPES), uses=["parcels"])
def prf4(spark, sf):
    return profile.schema_summary(table(spark, sf, "parcels"))


_NUM = ["UniqueID", "SalePrice"]
_TXT = [c for c, _ in _SPARK_TYPES if c not in _NUM]


def _profile_sql() -> str:
    parts = []
    for c in _NUM:
        parts.append(
            f"SELECT '{c}' AS column, CAST(COUNT({c}) AS BIGINT) AS count, CAST(NULL AS BIGINT) AS unique, "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, "
            f"ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS mean, ROUND(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, "
            f"ROUND(MIN(CAST({c} AS DOUBLE)), 6) AS min, "
            f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, "
            f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q2, "
            f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3, "
            f"ROUND(MAX(CAST({c} AS DOUBLE)), 6) AS max FROM parcels")
    for c in _TXT:
        v = f"CAST({c} AS VARCHAR)"
        parts.append(
            f"SELECT '{c}', CAST(COUNT({c}) AS BIGINT), CAST(COUNT(DISTINCT {c}) AS BIGINT), "
            f"(SELECT v FROM (SELECT {v} AS v, COUNT(*) AS k FROM parcels WHERE {c} IS NOT NULL "
            f"GROUP BY 1 ORDER BY k DESC, v LIMIT 1)), "
            f"(SELECT CAST(COUNT(*) AS BIGINT) AS k FROM parcels WHERE {c} IS NOT NULL GROUP BY {v} "
            f"ORDER BY k DESC LIMIT 1), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM parcels")
    return " UNION ALL ".join(parts)


@query("prf3_profile", _profile_sql(), uses=["parcels"])
def prf3(spark, sf):
    p = profile.profile(table(spark, sf, "parcels"))
    return p.select("column", "count", "unique", "top", "freq",
                    *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "q1", "q2", "q3",
                                                       "max")])
