"""P2 parcel cleaning: date normalisation, filling addresses from sibling
rows, address splitting, recoding, duplicate detection and column removal
(DT1, JN2-3, CND1, STR1-5, AGG4, WIN2, FLT2, FLT5, SET3-4, SRT3, PRJ4-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.dates import to_date
from ..operators import aggregates as agg
from ..operators import joins, relational as rel, windows
from ..session import scratch_path, stored
from ..sources import stored as tables
from .catalog import query, table

P = "parcels"
DUP_KEYS = ["ParcelID", "PropertyAddress", "SalePrice", "SaleDate", "LegalReference"]
RECODE = {"Y": "Yes", "N": "No"}


def parcels(spark, sf) -> DataFrame:
    return table(spark, sf, P)


def with_sale_date(df: DataFrame) -> DataFrame:
    return rel.set_column(df, "SaleDateConverted", to_date("SaleDate"))


def filled(df: DataFrame) -> DataFrame:
    return joins.fill_from_group(df, "ParcelID", "UniqueID", "PropertyAddress")


def split_addresses(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "PropertySplitAddress": S.before_first("PropertyAddress"),
        "PropertySplitCity": S.after_first("PropertyAddress"),
        "OwnerSplitAddress": S.part_from_right("OwnerAddress", 3),
        "OwnerSplitCity": S.part_from_right("OwnerAddress", 2),
        "OwnerSplitState": S.part_from_right("OwnerAddress", 1),
    })


def cleaned(spark, sf) -> DataFrame:
    """All steps of the script in data-flow order; the last one drops the
    raw columns (N:15-191)."""
    df = with_sale_date(parcels(spark, sf))
    df = split_addresses(filled(df))
    df = rel.set_column(df, "SoldAsVacant", S.recode("SoldAsVacant", RECODE))
    return rel.drop_columns(df, "OwnerAddress", "TaxDistrict", "PropertyAddress", "SaleDate")


_FILL_SQL = """
, fills AS (SELECT ParcelID, arg_min(PropertyAddress, UniqueID) AS fill
            FROM parcels WHERE PropertyAddress IS NOT NULL GROUP BY ParcelID),
pf AS (SELECT p.* REPLACE (COALESCE(p.PropertyAddress, f.fill) AS PropertyAddress)
       FROM parcels p LEFT JOIN fills f ON p.ParcelID = f.ParcelID)
"""

_SPLIT_SQL = """
CASE WHEN instr(PropertyAddress, ',') > 0
     THEN substring(PropertyAddress, 1, instr(PropertyAddress, ',') - 1) END AS PropertySplitAddress,
CASE WHEN instr(PropertyAddress, ',') > 0
     THEN substring(PropertyAddress, instr(PropertyAddress, ',') + 1, length(PropertyAddress)) END
  AS PropertySplitCity,
CASE WHEN len(string_split(replace(OwnerAddress, ',', '.'), '.')) <= 4
     THEN nullif(list_extract(string_split(replace(OwnerAddress, ',', '.'), '.'), -3), '') END
  AS OwnerSplitAddress,
CASE WHEN len(string_split(replace(OwnerAddress, ',', '.'), '.')) <= 4
     THEN nullif(list_extract(string_split(replace(OwnerAddress, ',', '.'), '.'), -2), '') END
  AS OwnerSplitCity,
CASE WHEN len(string_split(replace(OwnerAddress, ',', '.'), '.')) <= 4
     THEN nullif(list_extract(string_split(replace(OwnerAddress, ',', '.'), '.'), -1), '') END
  AS OwnerSplitState
"""


@query("dt1_to_date", "SELECT UniqueID, CAST(SaleDate AS DATE) AS SaleDateConverted FROM parcels",
       uses=[P])
def dt1(spark, sf):
    return with_sale_date(parcels(spark, sf)).select("UniqueID", "SaleDateConverted")


@query("prj6_set_column", f"""
SELECT UniqueID, CAST(SaleDate AS DATE) AS SaleDateConverted, {_SPLIT_SQL},
       CASE WHEN SoldAsVacant = 'Y' THEN 'Yes' WHEN SoldAsVacant = 'N' THEN 'No'
            ELSE SoldAsVacant END AS SoldAsVacant
FROM parcels""", uses=[P])
def prj6(spark, sf):
    df = split_addresses(with_sale_date(parcels(spark, sf)))
    df = rel.set_column(df, "SoldAsVacant", S.recode("SoldAsVacant", RECODE))
    return df.select("UniqueID", "SaleDateConverted", "PropertySplitAddress", "PropertySplitCity",
                     "OwnerSplitAddress", "OwnerSplitCity", "OwnerSplitState", "SoldAsVacant")


@query("flt2_where_null", "SELECT UniqueID, ParcelID FROM parcels WHERE PropertyAddress IS NULL",
       uses=[P])
def flt2(spark, sf):
    return rel.where_null(parcels(spark, sf), "PropertyAddress").select("UniqueID", "ParcelID")


@query("srt3_order_by_name",
       "SELECT UniqueID, ParcelID, PropertyAddress FROM parcels ORDER BY ParcelID", uses=[P])
def srt3(spark, sf):
    return rel.order_by(parcels(spark, sf).select("UniqueID", "ParcelID", "PropertyAddress"),
                        "ParcelID")


@query("jn2_fill_candidates", """
, g AS (SELECT ParcelID, COUNT(*) AS n, COUNT(PropertyAddress) AS nn FROM parcels GROUP BY ParcelID),
fills AS (SELECT ParcelID, arg_min(PropertyAddress, UniqueID) AS fill
          FROM parcels WHERE PropertyAddress IS NOT NULL GROUP BY ParcelID)
SELECT p.ParcelID, p.UniqueID, p.PropertyAddress, CAST(g.n - 1 AS BIGINT) AS n_partners,
       CAST(g.nn AS BIGINT) AS n_partners_with_value, f.fill AS fill_value,
       COALESCE(p.PropertyAddress, f.fill) AS filled
FROM parcels p JOIN g ON p.ParcelID = g.ParcelID LEFT JOIN fills f ON p.ParcelID = f.ParcelID
WHERE p.PropertyAddress IS NULL AND g.n > 1""", uses=[P])
def jn2(spark, sf):
    out = joins.fill_candidates(parcels(spark, sf), "ParcelID", "UniqueID", "PropertyAddress")
    return out.filter(F.col("n_partners") > 0)


@query("jn3_fill_from_group", _FILL_SQL + "SELECT UniqueID, PropertyAddress FROM pf", uses=[P])
def jn3(spark, sf):
    return filled(parcels(spark, sf)).select("UniqueID", "PropertyAddress")


@query("prj7_update_where", _FILL_SQL + "SELECT UniqueID, ParcelID, PropertyAddress FROM pf",
       uses=[P])
def prj7(spark, sf):
    """``UPDATE … SET PropertyAddress = fill WHERE PropertyAddress IS NULL``."""
    p = parcels(spark, sf).withColumn("fill", F.col("PropertyAddress"))
    j = joins.fill_from_group(p, "ParcelID", "UniqueID", "fill")
    out = rel.update_where(j, "PropertyAddress", F.col("fill"), F.col("PropertyAddress").isNull())
    return out.select("UniqueID", "ParcelID", "PropertyAddress")


STORED = ("UniqueID bigint, ParcelID string, PropertyAddress string, SoldAsVacant string, "
          "SaleYear int")
BEFORE = 1995


@query("prj7_update_stored", """
, fills AS (SELECT ParcelID, arg_min(PropertyAddress, UniqueID) AS fill
            FROM parcels WHERE PropertyAddress IS NOT NULL GROUP BY ParcelID),
u AS (SELECT p.*, CAST(year(SaleDate) AS INT) AS SaleYear, f.fill,
             PropertyAddress IS NULL AND f.fill IS NOT NULL AND year(SaleDate) < 1995 AS hit
      FROM parcels p LEFT JOIN fills f ON p.ParcelID = f.ParcelID)
SELECT UniqueID, ParcelID, CASE WHEN hit THEN fill ELSE PropertyAddress END AS PropertyAddress,
       SoldAsVacant, SaleYear, bool_or(hit) OVER (PARTITION BY SaleYear) AS rewritten
FROM u""", uses=[P])
def prj7_stored(spark, sf):
    """``UPDATE a SET PropertyAddress = fill FROM … WHERE PropertyAddress IS
    NULL`` on a stored table, for the sales before 1995: the rows afterwards, and
    whether the file that holds a row is a new one."""
    path = scratch_path(spark, "parcels")
    year = F.year("SaleDate").alias("SaleYear")
    tables.write_stored(parcels(spark, sf).select(
        "UniqueID", "ParcelID", "PropertyAddress", "SoldAsVacant", year), path, ["SaleYear"])

    def files():
        return (spark.read.schema(STORED).parquet(path)
                .select("SaleYear", F.col("_metadata.file_name").alias("file")).distinct())

    old = stored(files(), "parcel_files")
    fills = (tables.read_stored(spark, path, STORED).where("PropertyAddress IS NOT NULL")
             .groupBy("ParcelID").agg(F.min_by("PropertyAddress", "UniqueID").alias("fill")))
    missing = F.col("PropertyAddress").isNull() & F.col("fill").isNotNull() & (F.col("SaleYear") < BEFORE)
    tables.update_stored(spark, path, STORED, ["SaleYear"], {"PropertyAddress": F.col("fill")}, missing,
                         using=fills, on=["ParcelID"])
    kept = files().join(old, ["SaleYear", "file"], "left_semi").select("SaleYear").distinct()
    rows = tables.read_stored(spark, path, STORED)
    return rows.join(kept.withColumn("kept", F.lit(True)), "SaleYear", "left").select(
        "UniqueID", "ParcelID", "PropertyAddress", "SoldAsVacant", "SaleYear",
        F.col("kept").isNull().alias("rewritten"))


@query("cnd1_coalesce",
       "SELECT UniqueID, COALESCE(PropertyAddress, OwnerAddress) AS address FROM parcels", uses=[P])
def cnd1(spark, sf):
    return parcels(spark, sf).select(
        "UniqueID", F.coalesce("PropertyAddress", "OwnerAddress").alias("address"))


@query("str1_before_first", """
SELECT UniqueID, CASE WHEN instr(PropertyAddress, ',') > 0
  THEN substring(PropertyAddress, 1, instr(PropertyAddress, ',') - 1) END AS PropertySplitAddress
FROM parcels""", uses=[P])
def str1(spark, sf):
    return parcels(spark, sf).select(
        "UniqueID", S.before_first("PropertyAddress").alias("PropertySplitAddress"))


@query("str2_after_first", """
SELECT UniqueID, CASE WHEN instr(PropertyAddress, ',') > 0
  THEN substring(PropertyAddress, instr(PropertyAddress, ',') + 1, length(PropertyAddress)) END
  AS PropertySplitCity
FROM parcels""", uses=[P])
def str2(spark, sf):
    return parcels(spark, sf).select(
        "UniqueID", S.after_first("PropertyAddress").alias("PropertySplitCity"))


@query("str3_replace",
       "SELECT UniqueID, replace(OwnerAddress, ',', '.') AS OwnerDotted FROM parcels", uses=[P])
def str3(spark, sf):
    return parcels(spark, sf).select(
        "UniqueID", S.replace("OwnerAddress", ",", ".").alias("OwnerDotted"))


@query("str4_part_from_right", f"""
SELECT UniqueID, {_SPLIT_SQL.split('AS PropertySplitCity,')[1]} FROM parcels""", uses=[P])
def str4(spark, sf):
    return parcels(spark, sf).select(
        "UniqueID", S.part_from_right("OwnerAddress", 3).alias("OwnerSplitAddress"),
        S.part_from_right("OwnerAddress", 2).alias("OwnerSplitCity"),
        S.part_from_right("OwnerAddress", 1).alias("OwnerSplitState"))


@query("str5_recode", """
SELECT UniqueID, CASE WHEN SoldAsVacant = 'Y' THEN 'Yes' WHEN SoldAsVacant = 'N' THEN 'No'
                      ELSE SoldAsVacant END AS SoldAsVacant
FROM parcels""", uses=[P])
def str5(spark, sf):
    return parcels(spark, sf).select(
        "UniqueID", S.recode("SoldAsVacant", RECODE).alias("SoldAsVacant"))


@query("agg4_value_counts_sql", """
SELECT SoldAsVacant, CAST(COUNT(SoldAsVacant) AS BIGINT) AS n
FROM parcels GROUP BY SoldAsVacant ORDER BY 2""", uses=[P])
def agg4(spark, sf):
    out = agg.value_counts_sql(parcels(spark, sf), "SoldAsVacant")
    return out.withColumn("n", F.col("n").cast("bigint")).orderBy("n")


@query("set3_distinct", "SELECT DISTINCT SoldAsVacant FROM parcels", uses=[P])
def set3(spark, sf):
    return rel.distinct(parcels(spark, sf), "SoldAsVacant")


_ROWNUM = ("CAST(ROW_NUMBER() OVER (PARTITION BY ParcelID, PropertyAddress, SalePrice, SaleDate, "
           "LegalReference ORDER BY UniqueID) AS INT) AS row_num")


@query("win2_row_number", f"SELECT UniqueID, {_ROWNUM} FROM parcels", uses=[P])
def win2(spark, sf):
    rows = parcels(spark, sf).select(*DUP_KEYS, "UniqueID")
    return windows.number_rows(rows, DUP_KEYS, "UniqueID").select("UniqueID", "row_num")


@query("flt5_duplicates", f"""
SELECT UniqueID, ParcelID, PropertyAddress, row_num
FROM (SELECT *, {_ROWNUM} FROM parcels) WHERE row_num > 1 ORDER BY PropertyAddress""", uses=[P])
def flt5(spark, sf):
    rows = parcels(spark, sf).select(*DUP_KEYS, "UniqueID")
    d = windows.duplicates(rows, DUP_KEYS, "UniqueID")
    return d.select("UniqueID", "ParcelID", "PropertyAddress", "row_num") \
        .orderBy("PropertyAddress", "UniqueID")


@query("set4_dedupe_by_key", f"""
SELECT UniqueID, ParcelID, PropertyAddress, SalePrice
FROM (SELECT *, {_ROWNUM} FROM parcels) WHERE row_num = 1""", uses=[P])
def set4(spark, sf):
    kept = windows.dedupe_by_key(parcels(spark, sf), DUP_KEYS, "UniqueID")
    return kept.select("UniqueID", "ParcelID", "PropertyAddress", "SalePrice")


@query("prj4_drop_columns", """
SELECT * EXCLUDE (OwnerAddress, TaxDistrict, PropertyAddress, SaleDate) FROM parcels""", uses=[P])
def prj4(spark, sf):
    return rel.drop_columns(parcels(spark, sf), "OwnerAddress", "TaxDistrict", "PropertyAddress",
                            "SaleDate")


@query("p2_clean_parcels", _FILL_SQL + f"""
SELECT UniqueID, ParcelID, SalePrice, LegalReference,
       CASE WHEN SoldAsVacant = 'Y' THEN 'Yes' WHEN SoldAsVacant = 'N' THEN 'No'
            ELSE SoldAsVacant END AS SoldAsVacant,
       CAST(SaleDate AS DATE) AS SaleDateConverted, {_SPLIT_SQL}
FROM pf""", uses=[P])
def p2(spark, sf):
    return cleaned(spark, sf)
