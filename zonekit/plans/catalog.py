"""The registered queries: each zone operator run over the star-schema test
tables, with an equivalent SQL text for an independent engine.

Double results are rounded so that two engines summing in different orders
agree. Queries that write tables, fit models or run streams do so while they are
built; the others are lazy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.functions.arrays import array_mean
from zonekit.functions.text import basic_norm, basic_norm_sql, canon, canon_sql
from zonekit.operators.conform import conform
from zonekit.operators.dedup import dedup, merge_by_priority, upsert
from zonekit.operators.model import (FLAG_FEATURES, NUMERIC_FEATURES, build_pipeline, hash_bucket, hash_split, load_model,
                                     prepare_features, regression_metrics, save_model, score, split_label, train)
from zonekit.operators.nested import explode_rows, flatten_if_nested
from zonekit.operators.reconcile import alias_table, reconcile
from zonekit.operators.rename import merge_synonyms, rename_columns
from zonekit.plans import catalog_jobs, star
from zonekit.plans.features import feature_means, feature_table, predict_prices
from zonekit.plans.kpi import kpi_table
from zonekit.session import scratch_path
from zonekit.schemas import NEIGHBORHOOD_RENAMES, DISTRICT_RENAMES, listing_schema

DIGITS = 4


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column (display precision for comparison)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def ts_text(col: str) -> F.Column:
    """Timestamp rendered as ISO text for engine-neutral comparison."""
    return F.date_format(F.col(col), TS_FORMAT).alias(col)


def _sources(spark, d):
    inc = star.income_docs(spark, d).withColumnRenamed("neigh_name ", "neighborhood_name")
    den = star.density_docs(spark, d).withColumnRenamed("neigh_name ", "neighborhood_name")
    return inc, den


# --------------------------------------------------------------------- SQL
# Shared SQL building blocks (DuckDB dialect) mirroring the adapters.

def _noisy_sql(col: str, variant: str) -> str:
    v1 = f"lower(replace({col}, '_', ' '))"
    v2 = f"replace(replace(replace({col}, 'A', '\u00c0'), 'E', '\u00c9'), '_', '-')"
    v3 = f"replace(replace(lower({col}), 'a', 'a\u0301'), '_', '\u00a0')"
    return (f"CASE WHEN {variant} = 0 THEN {col} WHEN {variant} = 1 THEN {v1} "
            f"WHEN {variant} = 2 THEN {v2} ELSE {v3} END")


def _display_sql(col: str) -> str:
    s = f"replace({col}, '_', ' ')"
    return f"concat(upper(substring({s}, 1, 1)), lower(substring({s}, 2)))"


LISTINGS_SQL = """
lst AS (
  SELECT l.l_orderkey AS _id, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate,
         l.l_extendedprice AS price, l.l_quantity AS size,
         CASE WHEN l.l_quantity = 0 THEN NULL ELSE l.l_extendedprice / l.l_quantity END AS priceByArea,
         l.l_discount AS latitude, l.l_tax AS longitude, l.l_linenumber AS rooms,
         CAST(l.l_partkey % 3 + 1 AS INTEGER) AS bathrooms,
         CAST(l.l_suppkey % 10 AS INTEGER) AS floor,
         CAST((l.l_partkey + l.l_suppkey) % 30 AS INTEGER) AS numPhotos,
         l.l_returnflag = 'R' AS exterior, l.l_linestatus = 'F' AS has360,
         l.l_discount >= 0.05 AS has3DTour, l.l_tax >= 0.04 AS hasLift,
         l.l_quantity >= 25 AS hasPlan, month(l.l_shipdate) <= 6 AS hasStaging,
         l.l_orderkey % 2 = 0 AS hasVideo,
         n.n_nationkey, n.n_name, r.r_name
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

INCOME_YEAR_SQL = """
inc_year AS (
  SELECT n.n_name AS neighborhood_name, n.n_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(count(*) AS INTEGER) AS pop, avg(o.o_totalprice) AS RFD
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_name, n.n_nationkey, year(o.o_orderdate))"""

DENSITY_YEAR_SQL = """
den_year AS (
  SELECT n.n_name AS neighborhood_name, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(count(*) AS DOUBLE) AS population, avg(l.l_quantity) AS density,
         avg(l.l_quantity * (1 - l.l_discount)) AS net_density
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY n.n_name, year(l.l_shipdate))"""


# ----------------------------------------------------------------- queries

def q_kpi_table(spark: SparkSession, d: str) -> DataFrame:
    """Per-neighbourhood KPIs from listings, income and density docs."""
    inc, den = _sources(spark, d)
    return rounded(kpi_table(star.listings(spark, d), inc, den))


SQL_KPI_TABLE = f"""
WITH {LISTINGS_SQL.strip()}, {INCOME_YEAR_SQL.strip()}, {DENSITY_YEAR_SQL.strip()},
rent AS (SELECT n_name AS neighborhood_name, avg(price) AS avg_rent, avg(latitude) AS avg_latitude,
                avg(longitude) AS avg_longitude, avg(priceByArea) AS avg_price_by_area
         FROM lst GROUP BY n_name),
inc AS (SELECT neighborhood_name, avg(RFD) AS avg_income FROM inc_year GROUP BY neighborhood_name),
den AS (SELECT neighborhood_name, avg(density) AS avg_density FROM den_year GROUP BY neighborhood_name)
SELECT r.neighborhood_name, round(r.avg_rent, 4) AS avg_rent, round(r.avg_latitude, 4) AS avg_latitude,
       round(r.avg_longitude, 4) AS avg_longitude, round(r.avg_price_by_area, 4) AS avg_price_by_area,
       round(i.avg_income, 4) AS avg_income, round(d.avg_density, 4) AS avg_density,
       i.avg_income IS NULL AS avg_income_imputed, d.avg_density IS NULL AS avg_density_imputed
FROM rent r LEFT JOIN inc i ON r.neighborhood_name = i.neighborhood_name
LEFT JOIN den d ON r.neighborhood_name = d.neighborhood_name
"""


def q_kpi_imputed(spark: SparkSession, d: str) -> DataFrame:
    """C7 + F5: listings keyed by the reference's basic normalisation of
    noisy names; names without an income/density match are imputed with
    the mean and flagged."""
    return _imputed(spark, d, impute_strategy="mean")


SQL_KPI_IMPUTED = f"""
WITH {LISTINGS_SQL.strip()}, {INCOME_YEAR_SQL.strip()}, {DENSITY_YEAR_SQL.strip()},
nl AS (SELECT *, {basic_norm_sql(_noisy_sql('n_name', '((l_orderkey + l_linenumber) % 4)'))} AS nkey FROM lst),
rent AS (SELECT nkey AS neighborhood_name, avg(price) AS avg_rent, avg(latitude) AS avg_latitude,
                avg(longitude) AS avg_longitude, avg(priceByArea) AS avg_price_by_area
         FROM nl GROUP BY nkey),
inc AS (SELECT {basic_norm_sql('neighborhood_name')} AS neighborhood_name, avg(RFD) AS avg_income
        FROM inc_year GROUP BY 1),
den AS (SELECT {basic_norm_sql('neighborhood_name')} AS neighborhood_name, avg(density) AS avg_density
        FROM den_year GROUP BY 1),
k AS (SELECT r.*, i.avg_income, d.avg_density FROM rent r
      LEFT JOIN inc i ON r.neighborhood_name = i.neighborhood_name
      LEFT JOIN den d ON r.neighborhood_name = d.neighborhood_name)
SELECT neighborhood_name, round(avg_rent, 4) AS avg_rent, round(avg_latitude, 4) AS avg_latitude,
       round(avg_longitude, 4) AS avg_longitude, round(avg_price_by_area, 4) AS avg_price_by_area,
       round(coalesce(avg_income, (SELECT avg(avg_income) FROM k)), 4) AS avg_income,
       round(coalesce(avg_density, (SELECT avg(avg_density) FROM k)), 4) AS avg_density,
       avg_income IS NULL AS avg_income_imputed, avg_density IS NULL AS avg_density_imputed
FROM k
"""

SQL_KPI_IMPUTED_CONSTANT = (SQL_KPI_IMPUTED
                            .replace("coalesce(avg_income, (SELECT avg(avg_income) FROM k))",
                                     "coalesce(avg_income, 0.0)")
                            .replace("coalesce(avg_density, (SELECT avg(avg_density) FROM k))",
                                     "coalesce(avg_density, 0.0)"))
assert SQL_KPI_IMPUTED_CONSTANT.count(", 0.0)") == 2

LINEITEM_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]


def q_dedup_listings(spark: SparkSession, d: str) -> DataFrame:
    """One row per (l_orderkey, l_linenumber), deterministic survivor."""
    li = star.table(spark, d, "lineitem")
    out = dedup(li, ["l_orderkey", "l_linenumber"], LINEITEM_ORDER)
    return out.select(*[ts_text(c) if c == "l_shipdate" else c for c in out.columns])


SQL_DEDUP_LISTINGS = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
                      l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM lineitem) t
WHERE rn = 1
"""


def q_latest_order_per_customer(spark: SparkSession, d: str) -> DataFrame:
    """D1 descending + O1: the latest order of every customer (ties broken
    by the whole row, descending), output globally sorted by customer."""
    o = star.table(spark, d, "orders")
    out = dedup(o, "o_custkey", ["o_orderdate", "o_orderkey"], descending=True, sort_result=True)
    return out.select(*[ts_text(c) if c == "o_orderdate" else c for c in out.columns])


SQL_LATEST_ORDER_PER_CUSTOMER = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
             ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC, o_totalprice DESC,
                      o_orderpriority DESC) AS rn
      FROM orders) t
WHERE rn = 1
ORDER BY o_custkey
"""


def q_kpi_imputed_constant(spark: SparkSession, d: str) -> DataFrame:
    """F5 constant strategy: as ``kpi_imputed`` with unmatched income and
    density set to 0 and flagged."""
    return _imputed(spark, d, impute_strategy="constant", impute_value=0.0)


def _customer_lookups(spark, d):
    c = star.table(spark, d, "customer")
    cid = F.col("c_custkey").cast("string")
    a = c.where(F.col("c_acctbal") >= 0).select(
        cid.alias("_id"), F.col("c_name").alias("neighborhood"),
        F.lower("c_name").alias("neighborhood_name"),
        F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("neighborhood_reconciled"))
    b = c.select(cid.alias("_id"), F.replace("c_name", F.lit("#"), F.lit(" ")).alias("ne"),
                 F.lower(F.replace("c_name", F.lit("#"), F.lit(" "))).alias("ne_n"),
                 F.col("c_name").alias("ne_re"))
    cc = c.select(cid.alias("_id"), F.upper("c_name").alias("ne"), F.lower("c_name").alias("ne_n"),
                  F.concat("c_mktsegment", F.lit(":"), "c_name").alias("ne_re"))
    return [a, b, cc]


def q_merge_lookup_neighborhood(spark: SparkSession, d: str) -> DataFrame:
    """Three lookup sources, short names renamed, unioned by
    name, one row per id from the highest-priority source."""
    out = merge_by_priority(_customer_lookups(spark, d), "_id", NEIGHBORHOOD_RENAMES, keep_rank=True)
    return out.withColumnRenamed("_src_rank", "src_rank")


SQL_MERGE_LOOKUP_NEIGHBORHOOD = """
WITH u AS (
  SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name AS neighborhood, lower(c_name) AS neighborhood_name,
         concat(c_name, ' (', c_mktsegment, ')') AS neighborhood_reconciled, 0 AS src_rank
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), replace(c_name, '#', ' '), lower(replace(c_name, '#', ' ')), c_name, 1
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), upper(c_name), lower(c_name), concat(c_mktsegment, ':', c_name), 2
  FROM customer)
SELECT _id, neighborhood, neighborhood_name, neighborhood_reconciled, src_rank
FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY src_rank, neighborhood, neighborhood_name,
                                    neighborhood_reconciled) AS rn FROM u) t
WHERE rn = 1
"""


def _supplier_lookups(spark, d):
    s = star.table(spark, d, "supplier")
    sid = F.col("s_suppkey").cast("string")
    nid = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    own = F.concat(F.lit("S"), sid)
    a = s.where(F.col("s_acctbal") >= 0).select(
        sid.alias("_id"), F.col("s_name").alias("district"), F.lower("s_name").alias("district_name"),
        F.col("s_name").alias("district_reconciled"), F.array(nid).alias("neighborhood_id"))
    b = s.select(sid.alias("_id"), F.replace("s_name", F.lit("#"), F.lit(" ")).alias("di"),
                 F.lower(F.replace("s_name", F.lit("#"), F.lit(" "))).alias("di_n"),
                 F.col("s_name").alias("di_re"), F.array(nid, own).alias("ne_id"))
    c = s.select(sid.alias("_id"), F.upper("s_name").alias("di"), F.lower("s_name").alias("di_n"),
                 F.concat(F.col("s_name"), F.lit(" district")).alias("di_re"),
                 F.array(own).alias("ne_id"))
    return [a, b, c]


def q_merge_lookup_district(spark: SparkSession, d: str) -> DataFrame:
    """As C3 for district lookups, carrying an array of member ids."""
    out = merge_by_priority(_supplier_lookups(spark, d), "_id", DISTRICT_RENAMES, keep_rank=True)
    return out.select("_id", "district", "district_name", "district_reconciled",
                      F.array_join("neighborhood_id", ",").alias("neighborhood_ids"),
                      F.col("_src_rank").alias("src_rank"))


SQL_MERGE_LOOKUP_DISTRICT = """
WITH u AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS district, lower(s_name) AS district_name,
         s_name AS district_reconciled, ['N' || CAST(s_nationkey AS VARCHAR)] AS neighborhood_id, 0 AS src_rank
  FROM supplier WHERE s_acctbal >= 0
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), replace(s_name, '#', ' '), lower(replace(s_name, '#', ' ')), s_name,
         ['N' || CAST(s_nationkey AS VARCHAR), 'S' || CAST(s_suppkey AS VARCHAR)], 1
  FROM supplier
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), upper(s_name), lower(s_name), s_name || ' district',
         ['S' || CAST(s_suppkey AS VARCHAR)], 2
  FROM supplier)
SELECT _id, district, district_name, district_reconciled,
       array_to_string(neighborhood_id, ',') AS neighborhood_ids, src_rank
FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY src_rank, district, district_name,
                                    district_reconciled) AS rn FROM u) t
WHERE rn = 1
"""


def _raw_batches(spark, d):
    """Landing-zone batch documents: listing fields as text, in another
    field order than the declared schema, one nested struct, and a
    malformed ``floor`` on line 7."""
    li = star.table(spark, d, "lineitem")
    floor_txt = F.pmod("l_suppkey", F.lit(10)).cast("string")
    item = [
        F.col("l_tax").cast("string").alias("longitude"),
        F.when(F.col("l_linenumber") == 7, F.concat(floor_txt, F.lit("x"))).otherwise(floor_txt).alias("floor"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.struct(F.col("l_discount").cast("string").alias("parkingSpacePrice"),
                 (F.col("l_returnflag") == "R").cast("string").alias("hasParkingSpace")).alias("parkingSpace"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("propertyCode"),
        F.col("l_quantity").cast("string").alias("size"),
        F.col("l_linenumber").cast("string").alias("rooms"),
        (F.col("l_tax") >= 0.04).cast("string").alias("hasLift"),
        F.col("l_discount").cast("string").alias("latitude"),
        F.lit("unused").alias("extraField"),
    ]
    return star.listing_batches(li, item)


def q_conform_listings(spark: SparkSession, d: str) -> DataFrame:
    """Text batch documents cast to the declared listing schema
    by name (nested struct included); malformed values become null."""
    batches = _raw_batches(spark, d)
    schema = T.StructType([T.StructField("_id", T.StringType()),
                           T.StructField("value", T.ArrayType(listing_schema()))])
    typed = conform(batches, schema)
    flat = explode_rows(typed, "value", keep=["_id"])
    return flat.select("propertyCode", "price", "size", "rooms", "floor", "hasLift", "latitude",
                       "longitude", F.col("parkingSpace.parkingSpacePrice").alias("parkingSpacePrice"),
                       F.col("parkingSpace.hasParkingSpace").alias("hasParkingSpace"),
                       F.col("address").alias("address"))


SQL_CONFORM_LISTINGS = """
SELECT concat_ws('-', l_orderkey, l_linenumber) AS propertyCode, l_extendedprice AS price,
       l_quantity AS size, l_linenumber AS rooms,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_suppkey % 10 AS INTEGER) END AS floor,
       l_tax >= 0.04 AS hasLift, l_discount AS latitude, l_tax AS longitude,
       l_discount AS parkingSpacePrice, l_returnflag = 'R' AS hasParkingSpace,
       CAST(NULL AS VARCHAR) AS address
FROM lineitem
"""


def q_explode_listings(spark: SparkSession, d: str) -> DataFrame:
    """Typed batch documents -> one row per listing (explode +
    star expansion, chosen from the schema)."""
    li = star.table(spark, d, "lineitem")
    item = [F.concat_ws("-", "l_orderkey", "l_linenumber").alias("propertyCode"),
            F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("size"),
            F.col("l_shipdate").alias("shipped")]
    batches = star.listing_batches(li, item)
    flat = flatten_if_nested(batches, "value", keep=["_id"])
    return flat.select(F.split("_id", ":").getItem(0).cast("long").alias("batch_order"),
                       "propertyCode", "price", "size", ts_text("shipped"))


SQL_EXPLODE_LISTINGS = """
SELECT l_orderkey AS batch_order, concat_ws('-', l_orderkey, l_linenumber) AS propertyCode,
       l_extendedprice AS price, l_quantity AS size,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped
FROM lineitem
"""


def q_rename_nested_density(spark: SparkSession, d: str) -> DataFrame:
    """Rename a top-level name with a trailing space and
    fields nested in ``info[]`` (names with spaces/parentheses), then
    flatten."""
    docs = star.density_docs(spark, d)
    out, missing = rename_columns(docs, {"neigh_name": "neighborhood_name",
                                         "info.density(inh/ha)": "density",
                                         "info.net_density (inh/ha)": "net_density"})
    if missing:
        raise ValueError(f"not renamed: {missing}")
    flat = explode_rows(out, "info", keep=["neighborhood_name"])
    return rounded(flat.select("neighborhood_name", "year", "population", "density", "net_density"))


SQL_RENAME_NESTED_DENSITY = f"""
WITH {DENSITY_YEAR_SQL.strip()}
SELECT neighborhood_name, year, round(population, 4) AS population, round(density, 4) AS density,
       round(net_density, 4) AS net_density
FROM den_year
"""


def q_array_mean_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """Mean and length of each embedding array (try_divide: an
    empty array gives null, not an error)."""
    e = star.table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.size("embedding").alias("dim"),
                    F.round(array_mean("embedding"), 6).alias("mean_value"),
                    F.round(array_mean("embedding", skip_nulls=True), 6).alias("mean_non_null"))


SQL_ARRAY_MEAN_EMBEDDINGS = """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / len(embedding), 6) AS mean_value,
       round(list_sum(list_transform(list_filter(embedding, lambda x: x IS NOT NULL), lambda x: CAST(x AS DOUBLE)))
             / len(list_filter(embedding, lambda x: x IS NOT NULL)), 6) AS mean_non_null
FROM embeddings
"""


def _alias_tables(spark, d):
    nl = star.neighborhood_lookups(spark, d)
    dl = star.district_lookups(spark, d)
    nmerged = merge_by_priority(nl, "_id", NEIGHBORHOOD_RENAMES)
    dmerged = merge_by_priority(dl, "_id", DISTRICT_RENAMES)
    nnames = ["neighborhood", "neighborhood_name", "neighborhood_reconciled", "ne", "ne_n", "ne_re"]
    dnames = ["district", "district_name", "district_reconciled", "di", "di_n", "di_re"]
    nal = alias_table([(s, nnames) for s in nl], display=nmerged, display_col="neighborhood_reconciled")
    dal = alias_table([(s, dnames) for s in dl], display=dmerged, display_col="district_reconciled")
    return nal, dal, nmerged, dmerged


def q_reconcile_listings(spark: SparkSession, d: str) -> DataFrame:
    """Noisy place names of every listing matched to
    district and neighbourhood ids through accent/case/punctuation
    insensitive alias tables; one row per listing key."""
    nal, dal, _, _ = _alias_tables(spark, d)
    order = ["l_partkey", "l_suppkey", "l_shipdate", "size", "price"]
    lst = star.noisy_listings(spark, d).select(
        "l_orderkey", "l_linenumber", *order, "district_name", "neighborhood_name")
    lst = dedup(lst, ["l_orderkey", "l_linenumber"], order)
    r = reconcile(lst, "district_name", dal, "district_reconciled", "district_id")
    r = reconcile(r, "neighborhood_name", nal, "neigh_name_reconciled", "neighborhood_id")
    return r.select("l_orderkey", "l_linenumber", "district_name", "neighborhood_name",
                    "district_id", "district_reconciled", "neighborhood_id", "neigh_name_reconciled")


def _lookup_union_sql(kind: str) -> str:
    if kind == "n":
        disp = _display_sql("n_name")
        return f"""
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS id, 0 AS src,
         [n_name, lower(replace(n_name, '_', ' ')), {disp}] AS names, {disp} AS reconciled FROM nation
  UNION ALL
  SELECT 'N' || CAST(n_nationkey AS VARCHAR), 1,
         [replace(n_name, '_', '-'), lower(replace(n_name, '_', '-')), {disp}], {disp} FROM nation
  UNION ALL
  SELECT 'N' || CAST(n_nationkey AS VARCHAR), 2,
         [replace(n_name, 'A', '\u00c0'), lower(replace(n_name, '_', ' ')), {disp} || ', Zone'],
         {disp} || ', Zone' FROM nation"""
    disp = _display_sql("r_name")
    return f"""
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS id, 0 AS src,
         [r_name, lower(r_name), {disp}] AS names, {disp} AS reconciled FROM region
  UNION ALL
  SELECT 'R' || CAST(r_regionkey AS VARCHAR), 1,
         [replace(r_name, ' ', '-'), lower(replace(r_name, ' ', '-')), {disp}], {disp} FROM region
  UNION ALL
  SELECT 'R' || CAST(r_regionkey AS VARCHAR), 2,
         [replace(r_name, 'E', '\u00c9'), lower(r_name), {disp} || ' district'],
         {disp} || ' district' FROM region"""


def _alias_sql(kind: str) -> str:
    return f"""
{kind}src AS ({_lookup_union_sql(kind)}),
{kind}disp AS (SELECT id, reconciled FROM (SELECT id, reconciled, row_number() OVER
          (PARTITION BY id ORDER BY src, reconciled) AS rn FROM {kind}src) t WHERE rn = 1),
{kind}al0 AS (SELECT {canon_sql('nm')} AS alias, id FROM {kind}src, unnest(names) AS u(nm)),
{kind}al AS (SELECT a.alias, a.id, p.reconciled FROM
          (SELECT alias, min(id) AS id FROM {kind}al0 WHERE alias IS NOT NULL AND alias <> ''
           GROUP BY alias HAVING min(id) = max(id)) a LEFT JOIN {kind}disp p ON a.id = p.id)"""


SQL_RECONCILE_LISTINGS = f"""
WITH {LISTINGS_SQL.strip()},
{_alias_sql('n').strip()},
{_alias_sql('r').strip()},
nl AS (SELECT l_orderkey, l_linenumber,
              {_noisy_sql('r_name', '((l_orderkey + l_linenumber) % 4)')} AS district_name,
              {_noisy_sql('n_name', '((l_orderkey + l_linenumber) % 4)')} AS neighborhood_name,
              row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_partkey, l_suppkey, l_shipdate, size, price) AS rn
       FROM lst),
d AS (SELECT * FROM nl WHERE rn = 1)
SELECT d.l_orderkey, d.l_linenumber, d.district_name, d.neighborhood_name,
       ra.id AS district_id, ra.reconciled AS district_reconciled,
       na.id AS neighborhood_id, na.reconciled AS neigh_name_reconciled
FROM d
LEFT JOIN ral ra ON {canon_sql('d.district_name')} = ra.alias
LEFT JOIN nal na ON {canon_sql('d.neighborhood_name')} = na.alias
"""


def q_reconcile_basic(spark: SparkSession, d: str) -> DataFrame:
    """C6 in the reference's mode: lower-case + combining-mark strip on
    both sides, against the merged lookup's pre-normalised names; names in
    other spellings stay unmatched (null). Counted per spelling."""
    nl = star.neighborhood_lookups(spark, d)
    merged = merge_by_priority(nl, "_id", NEIGHBORHOOD_RENAMES)
    aliases = merged.select(F.col("neighborhood_name").alias("alias"), F.col("_id").alias("id"),
                            F.col("neighborhood_reconciled").alias("reconciled"))
    lst = star.noisy_listings(spark, d).select("l_orderkey", "l_linenumber", "neighborhood_name")
    r = reconcile(lst, "neighborhood_name", aliases, "neigh_name_reconciled", "neighborhood_id",
                  mode="basic")
    return (r.groupBy("neighborhood_name", "neighborhood_id", "neigh_name_reconciled")
            .agg(F.count(F.lit(1)).alias("listings")))


SQL_RECONCILE_BASIC = f"""
WITH {LISTINGS_SQL.strip()},
m AS (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS id, lower(replace(n_name, '_', ' ')) AS nname,
             {_display_sql('n_name')} AS reconciled FROM nation),
a AS (SELECT {basic_norm_sql('nname')} AS k, min(id) AS id, min(reconciled) AS reconciled FROM m GROUP BY 1),
nl AS (SELECT {_noisy_sql('n_name', '((l_orderkey + l_linenumber) % 4)')} AS neighborhood_name FROM lst)
SELECT nl.neighborhood_name, a.id AS neighborhood_id, a.reconciled AS neigh_name_reconciled,
       count(*) AS listings
FROM nl LEFT JOIN a ON {basic_norm_sql('nl.neighborhood_name')} = a.k
GROUP BY 1, 2, 3
"""


def q_canon_documents(spark: SparkSession, d: str) -> DataFrame:
    """X1/X2 over whole document texts: the matching key and the
    reference's lower-case/strip form."""
    docs = star.table(spark, d, "documents")
    return docs.select("doc_id", canon("text").alias("canon_text"),
                       basic_norm("text").alias("basic_text"))


SQL_CANON_DOCUMENTS = f"""
SELECT doc_id, {canon_sql('text')} AS canon_text, {basic_norm_sql('text')} AS basic_text
FROM documents
"""


def q_filter_project_orders(spark: SparkSession, d: str) -> DataFrame:
    """Filter on a column that is not selected, null out one
    priority, drop rows null in a subset, drop a column by name."""
    o = star.table(spark, d, "orders")
    out = (o.where(F.col("o_orderstatus") == "F")
           .select("o_orderkey", "o_custkey", "o_totalprice",
                   F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"))
           .dropna(subset=["o_orderpriority"])
           .dropna()
           .drop("o_custkey"))
    return out


SQL_FILTER_PROJECT_ORDERS = """
SELECT o_orderkey, o_totalprice, nullif(o_orderpriority, '5-LOW') AS o_orderpriority
FROM orders
WHERE o_orderstatus = 'F' AND nullif(o_orderpriority, '5-LOW') IS NOT NULL
"""


def q_feature_table(spark: SparkSession, d: str) -> DataFrame:
    """Listings x income docs x density docs (inner joins on the
    neighbourhood), with the array columns summarised."""
    inc, den = _sources(spark, d)
    ft = feature_table(star.listings(spark, d), inc, den)
    return rounded(ft.select(
        "_id", "rooms", "size", "price", "neighborhood_name", "income_id",
        F.size("income_year").alias("income_years"), array_mean("RFD").alias("rfd_mean"),
        "density_neighborhood_name", F.size("density_year").alias("density_years"),
        array_mean("density").alias("density_mean")))


SQL_FEATURE_TABLE = f"""
WITH {LISTINGS_SQL.strip()}, {INCOME_YEAR_SQL.strip()}, {DENSITY_YEAR_SQL.strip()},
inc AS (SELECT neighborhood_name, min(n_nationkey) AS income_id, CAST(count(*) AS INTEGER) AS income_years,
               avg(RFD) AS rfd_mean FROM inc_year GROUP BY neighborhood_name),
den AS (SELECT neighborhood_name, CAST(count(*) AS INTEGER) AS density_years, avg(density) AS density_mean
        FROM den_year GROUP BY neighborhood_name)
SELECT l._id, l.rooms, round(l.size, 4) AS size, round(l.price, 4) AS price, l.n_name AS neighborhood_name,
       i.income_id, i.income_years, round(i.rfd_mean, 4) AS rfd_mean,
       d.neighborhood_name AS density_neighborhood_name, d.density_years,
       round(d.density_mean, 4) AS density_mean
FROM lst l JOIN inc i ON l.n_name = i.neighborhood_name JOIN den d ON l.n_name = d.neighborhood_name
"""


def q_string_index_flags(spark: SparkSession, d: str) -> DataFrame:
    """M1/M2: one multi-column StringIndexer over the seven listing flags
    (most frequent label -> 0, ties alphabetical)."""
    from pyspark.ml.feature import StringIndexer
    lst = star.listing_columns(star.table(spark, d, "lineitem"))
    lst = lst.select("l_orderkey", "l_linenumber", *[F.col(c).cast("string").alias(c) for c in FLAG_FEATURES])
    idx = StringIndexer(inputCols=FLAG_FEATURES, outputCols=[f"{c}_index" for c in FLAG_FEATURES],
                        handleInvalid="skip").fit(lst)
    return idx.transform(lst).select("l_orderkey", "l_linenumber",
                                     *[f"{c}_index" for c in FLAG_FEATURES])


def _string_index_sql() -> str:
    flags = {"exterior": "l_returnflag = 'R'", "has360": "l_linestatus = 'F'",
             "has3DTour": "l_discount >= 0.05", "hasLift": "l_tax >= 0.04",
             "hasPlan": "l_quantity >= 25", "hasStaging": "month(l_shipdate) <= 6",
             "hasVideo": "l_orderkey % 2 = 0"}
    ctes = [f"b AS (SELECT l_orderkey, l_linenumber, "
            + ", ".join(f"CAST({e} AS VARCHAR) AS {c}" for c, e in flags.items()) + " FROM lineitem)"]
    joins, cols = [], []
    for c in flags:
        ctes.append(f"i_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS ix "
                    f"FROM (SELECT {c} AS v, count(*) AS n FROM b GROUP BY {c}) t)")
        joins.append(f"JOIN i_{c} ON b.{c} = i_{c}.v")
        cols.append(f"i_{c}.ix AS {c}_index")
    return ("WITH " + ",\n".join(ctes) + "\nSELECT b.l_orderkey, b.l_linenumber, " + ", ".join(cols)
            + "\nFROM b " + " ".join(joins))


SQL_STRING_INDEX_FLAGS = _string_index_sql()


def q_regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    """RMSE, MAE, MSE, R2 of a quantity-based price estimate (in
    thousands) over every line, in one aggregation."""
    li = star.table(spark, d, "lineitem")
    pred = li.select((F.col("l_extendedprice") / 1000).alias("price"),
                     (F.col("l_quantity") * 1.5).alias("prediction"))
    return rounded(regression_metrics(pred), 6)


SQL_REGRESSION_METRICS = """
WITH p AS (SELECT l_extendedprice / 1000 AS price, l_quantity * 1.5 AS prediction FROM lineitem),
a AS (SELECT avg((prediction - price) * (prediction - price)) AS mse, avg(abs(prediction - price)) AS mae,
             var_pop(price) AS v, count(*) AS n FROM p)
SELECT round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae, round(mse, 6) AS mse,
       round(1 - mse / v, 6) AS r2, n
FROM a
"""

UPSERT_CUTOFF_EXISTING = "1999-01-01"
UPSERT_CUTOFF_INCOMING = "1998-01-01"


def q_upsert_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders placed before 1999 are the stored table; orders from
    1998 on arrive repriced (+100) and replace stored rows with the same key."""
    o = star.table(spark, d, "orders")
    existing = o.where(F.col("o_orderdate") < F.lit(UPSERT_CUTOFF_EXISTING).cast("timestamp_ntz"))
    incoming = (o.where(F.col("o_orderdate") >= F.lit(UPSERT_CUTOFF_INCOMING).cast("timestamp_ntz"))
                .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(100.0))
                .withColumn("o_orderstatus", F.lit("U")))
    out = upsert(existing, incoming, "o_orderkey")
    return out.select(*[ts_text(c) if c == "o_orderdate" else c for c in out.columns])


SQL_UPSERT_ORDERS = f"""
WITH ex AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{UPSERT_CUTOFF_EXISTING}'),
inc AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 100.0 AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '{UPSERT_CUTOFF_INCOMING}')
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM (SELECT * FROM inc
      UNION ALL
      SELECT * FROM ex WHERE o_orderkey NOT IN (SELECT o_orderkey FROM inc)) u
"""


def q_hash_split_counts(spark: SparkSession, d: str) -> DataFrame:
    """M4: repeatable 75/25 split of the listings by key hash; row counts."""
    li = star.table(spark, d, "lineitem")
    return (li.select(split_label(["l_orderkey", "l_linenumber"]).alias("part"))
            .groupBy("part").agg(F.count(F.lit(1)).alias("n")))


SQL_BUCKET = "('0x' || substr(md5(concat_ws('|', '0', l_orderkey, l_linenumber)), 1, 8))::bigint % 100"

SQL_HASH_SPLIT_COUNTS = f"""
SELECT CASE WHEN {SQL_BUCKET} < 75 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM lineitem GROUP BY 1
"""


def _flag_model(spark: SparkSession, d: str):
    """(model saved and loaded again, held-out rows): one flag, one tree of
    depth one, whose prediction has a closed form, the mean price of the training rows
    with that flag value."""
    li = star.listing_columns(star.table(spark, d, "lineitem"))
    df = prepare_features(li.select("l_orderkey", "l_linenumber", "exterior", "price"), numeric=[], flags=["exterior"])
    tr, te = hash_split(df, ["l_orderkey", "l_linenumber"])
    model = train(tr, build_pipeline(numeric=[], flags=["exterior"], maxIter=1, maxDepth=1))
    path = scratch_path(spark, "models", uuid.uuid4().hex)
    save_model(model, path)
    return load_model(path), te


def q_model_flag_means(spark: SparkSession, d: str) -> DataFrame:
    """Fit, save, load, score and measure a model whose
    predictions are known (see ``_flag_model``); metrics per flag value."""
    model, te = _flag_model(spark, d)
    pred = score(model, te)
    return rounded(pred.groupBy("exterior").agg(
        F.min("prediction").alias("least"), F.max("prediction").alias("most"), F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg((F.col("prediction") - F.col("price")) ** 2)).alias("rmse"), F.avg(F.abs(F.col("prediction") - F.col("price"))).alias("mae")))


SQL_MODEL_FLAG_MEANS = f"""
WITH b AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END AS exterior, l_extendedprice AS price,
                  {SQL_BUCKET} AS bucket FROM lineitem),
m AS (SELECT exterior, avg(price) AS p FROM b WHERE bucket < 75 GROUP BY 1)
SELECT exterior, round(min(p), 4) AS least, round(max(p), 4) AS most, count(*) AS n,
       round(sqrt(avg((p - price) * (p - price))), 4) AS rmse, round(avg(abs(p - price)), 4) AS mae
FROM b JOIN m USING (exterior) WHERE bucket >= 75 GROUP BY 1
"""


def q_predict_listings(spark: SparkSession, d: str) -> DataFrame:
    """M6: a price, or the reason why there is none, for every listing: names
    in four spellings (most match no document), null names and null flags."""
    model, _ = _flag_model(spark, d)
    inc, den = _sources(spark, d)
    inc, den = (x.withColumn("neighborhood_name", basic_norm("neighborhood_name")) for x in (inc, den))
    new = star.noisy_listings(spark, d).drop("price")
    name = F.when(F.col("l_linenumber") != 6, basic_norm("neighborhood_name"))
    flag = F.when(F.col("l_linenumber") != 5, F.col("exterior"))
    new = new.withColumns({"neighborhood_name": name, "exterior": flag, "floor": F.col("l_linenumber")})
    out = predict_prices(model, new, inc, den)
    return rounded(out.select("_id", F.col("floor").cast("long").alias("line"), "not_priced", "prediction"))


SQL_PREDICT_LISTINGS = f"""
WITH {LISTINGS_SQL.strip()}, {INCOME_YEAR_SQL.strip()}, {DENSITY_YEAR_SQL.strip()},
m AS (SELECT l_returnflag = 'R' AS exterior, avg(l_extendedprice) AS p FROM lineitem WHERE {SQL_BUCKET} < 75 GROUP BY 1),
nl AS (SELECT _id, l_linenumber AS line, CASE WHEN l_linenumber <> 5 THEN exterior END AS exterior,
              CASE WHEN l_linenumber <> 6 THEN {basic_norm_sql(_noisy_sql('n_name', '((l_orderkey + l_linenumber) % 4)'))} END AS nkey FROM lst),
k AS (SELECT DISTINCT {basic_norm_sql('i.neighborhood_name')} AS nkey FROM inc_year i JOIN den_year d USING (neighborhood_name))
SELECT nl._id, CAST(line AS BIGINT) AS line,
       CASE WHEN k.nkey IS NULL THEN 'no documents' WHEN nl.exterior IS NULL THEN 'incomplete' END AS not_priced,
       CASE WHEN k.nkey IS NOT NULL AND nl.exterior IS NOT NULL THEN round(m.p, 4) END AS prediction
FROM nl LEFT JOIN k ON nl.nkey = k.nkey LEFT JOIN m ON nl.exterior = m.exterior
"""


def q_conflicting_listings(spark: SparkSession, d: str) -> DataFrame:
    """Batch documents that arrive twice, listings that occur in
    several batches with different values, and listings without code: the newest
    batch wins, copies of a document count once, rows without code stay."""
    from zonekit.plans.zones import flat_listings, newest_listings

    flat = flat_listings(star.conflicting_batches(spark, d))
    return newest_listings(flat).select("_id", "propertyCode", "price", "size", "rooms")


SQL_CONFLICTING_LISTINGS = """
WITH l AS (SELECT concat(l_orderkey, ':', year(l_shipdate)) AS _id,
                  CASE WHEN l_linenumber <> 5 THEN concat(l_orderkey, '-', l_linenumber) END AS propertyCode,
                  l_extendedprice AS price, l_quantity AS size, l_linenumber AS rooms FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY propertyCode ORDER BY _id DESC, price DESC, size DESC) AS rn FROM l)
SELECT _id, propertyCode, price, size, CAST(rooms AS INTEGER) AS rooms FROM r WHERE propertyCode IS NULL OR rn = 1
"""


def q_kpi_imputed_random(spark: SparkSession, d: str) -> DataFrame:
    """As ``kpi_imputed`` with fills drawn from a hash of the row key."""
    return _imputed(spark, d, impute_strategy="random", seed=7)


def q_kpi_imputed_median(spark: SparkSession, d: str) -> DataFrame:
    """as ``kpi_imputed`` with the median."""
    return _imputed(spark, d, impute_strategy="median")


def _imputed(spark, d, **how) -> DataFrame:
    inc, den = _sources(spark, d)
    inc = inc.withColumn("neighborhood_name", basic_norm("neighborhood_name"))
    den = den.withColumn("neighborhood_name", basic_norm("neighborhood_name"))
    lst = star.noisy_listings(spark, d).withColumn("neighborhood_name", basic_norm("neighborhood_name"))
    return rounded(kpi_table(lst, inc, den, **how))


def _filled_sql(fill) -> str:
    out = SQL_KPI_IMPUTED
    for c in ("avg_income", "avg_density"):
        old = f"coalesce({c}, (SELECT avg({c}) FROM k))"
        assert old in out
        out = out.replace(old, f"coalesce({c}, {fill(c)})")
    return out


SQL_KPI_IMPUTED_RANDOM = _filled_sql(
    lambda c: f"('0x' || substr(md5(concat_ws('|', '7', '{c}', coalesce(neighborhood_name, ''))), 1, 8))::bigint::double / 4294967296.0 * 1000.0")
SQL_KPI_IMPUTED_MEDIAN = _filled_sql(lambda c: f"(SELECT quantile_disc({c}, 0.5) FROM k)")


def q_lookup_files(spark: SparkSession, d: str) -> DataFrame:
    """Lookup documents written as JSON lines, read with the declared
    schema, merged, and the merged table written twice (drop-then-write)."""
    from zonekit.schemas import lookup_neighborhood_schema
    from zonekit.sinks.writers import write_collection, write_table
    from zonekit.sources.readers import read_collection, read_json_lines

    root = scratch_path(spark, "lookups", uuid.uuid4().hex)
    sources = []
    for i, s in enumerate(_customer_lookups(spark, d)):
        write_table(s, f"{root}/source{i}", fmt="json")
        sources.append(merge_synonyms(read_json_lines(spark, f"{root}/source{i}", lookup_neighborhood_schema()), NEIGHBORHOOD_RENAMES))
    merged = merge_by_priority(sources, "_id", keep_rank=True).withColumnRenamed("_src_rank", "src_rank")
    write_table(merged.where("src_rank > 0"), f"{root}/merged")
    write_collection(merged, "parquet", path=f"{root}/merged", mode="overwrite")
    return read_collection(spark, "parquet", path=f"{root}/merged")


def model_frame(spark: SparkSession, d: str) -> DataFrame:
    inc, den = _sources(spark, d)
    # the tree learner samples its bins from the rows as they lie, so the joins that place them stay as they are
    listings = star.listings(spark, d, places_of_suppliers=star.supplier_places(spark, d))
    ft = feature_means(listings, inc, den)
    return prepare_features(ft.dropna().withColumn("l_linenumber", F.col("rooms")))


def q_gbt_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Feature table (materialised once) -> hash split ->
    indexers + assembler + GBT (reference parameters) -> predictions ->
    metrics."""
    # the model's columns and the bucket of the split only, written once as a table: the train and test
    # sides read it instead of each re-running the listing joins and the digests
    path = scratch_path(spark, "model_frames", uuid.uuid4().hex)
    bucket = hash_bucket(["_id", "l_linenumber"])
    model_frame(spark, d).select(bucket.alias("bucket"), *NUMERIC_FEATURES, *FLAG_FEATURES, "price").write.parquet(path)
    rows = spark.read.parquet(path)
    tr, te = rows.where("bucket < 75"), rows.where("bucket >= 75")
    model = train(tr, build_pipeline())
    return rounded(regression_metrics(score(model, te)), 6)


def q_kpi_stream(spark: SparkSession, d: str) -> DataFrame:
    """E2/C7 incremental: the lineitem files read as a file stream; each
    micro-batch joins the supplier places as a batch plan (adaptive
    execution on) and adds its sums per key; returns the current rent KPIs."""
    from zonekit.streaming.kpi_stream import current_rent_kpis, start_rent_kpi_stream

    root = scratch_path(spark, "streams", f"kpi-{uuid.uuid4().hex}")
    # a pattern, so that the source may be one file or a folder of part files
    stream = (spark.readStream.schema(star.table(spark, d, "lineitem").schema)
              .parquet(f"{d.rstrip('/')}/lineitem.parque[t]"))
    q = start_rent_kpi_stream(stream, f"{root}/out", f"{root}/checkpoint",
                              prepare=lambda batch: star.listings(spark, d, lineitem=batch))
    q.awaitTermination()
    return rounded(current_rent_kpis(spark, f"{root}/out"))


SQL_KPI_STREAM = f"""
WITH {LISTINGS_SQL.strip()}
SELECT n_name AS neighborhood_name, round(avg(price), 4) AS avg_rent, round(avg(latitude), 4) AS avg_latitude,
       round(avg(longitude), 4) AS avg_longitude, round(avg(priceByArea), 4) AS avg_price_by_area
FROM lst GROUP BY n_name
"""


def q_zones_kpis(spark: SparkSession, d: str) -> DataFrame:
    """The whole zone job over landing documents derived from the test
    tables (batch de-duplication, by-name conform, renames, explode,
    two-level reconciliation of noisy names, listing de-duplication, KPI
    table keyed by the reconciled name); returns the written KPI table."""
    from zonekit.plans.zones import ZoneConfig, run_zones

    out = run_zones(spark, star.zone_inputs(spark, d), ZoneConfig(steps=("formatted", "kpis")))
    return rounded(spark.read.parquet(out["kpis"]))


SQL_ZONES_KPIS = f"""
WITH {LISTINGS_SQL.strip()}, {INCOME_YEAR_SQL.strip()}, {DENSITY_YEAR_SQL.strip()},
l2 AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, price, latitude, longitude, size,
                       priceByArea, n_name FROM lst),
rent AS (SELECT {_display_sql('n_name')} AS neigh_name_reconciled, avg(price) AS avg_rent,
                avg(latitude) AS avg_latitude, avg(longitude) AS avg_longitude,
                avg(priceByArea) AS avg_price_by_area FROM l2 GROUP BY 1),
inc AS (SELECT {_display_sql('neighborhood_name')} AS k, avg(RFD) AS avg_income FROM inc_year GROUP BY 1),
den AS (SELECT {_display_sql('neighborhood_name')} AS k, avg(density) AS avg_density FROM den_year GROUP BY 1)
SELECT r.neigh_name_reconciled, round(avg_rent, 4) AS avg_rent, round(avg_latitude, 4) AS avg_latitude,
       round(avg_longitude, 4) AS avg_longitude, round(avg_price_by_area, 4) AS avg_price_by_area,
       round(avg_income, 4) AS avg_income, round(avg_density, 4) AS avg_density,
       avg_income IS NULL AS avg_income_imputed, avg_density IS NULL AS avg_density_imputed
FROM rent r LEFT JOIN inc i ON r.neigh_name_reconciled = i.k LEFT JOIN den d ON r.neigh_name_reconciled = d.k
"""


def queries() -> dict:
    return {
        "kpi_table": q_kpi_table,
        "kpi_imputed": q_kpi_imputed,
        "kpi_imputed_constant": q_kpi_imputed_constant,
        "dedup_listings": q_dedup_listings,
        "latest_order_per_customer": q_latest_order_per_customer,
        "merge_lookup_neighborhood": q_merge_lookup_neighborhood,
        "merge_lookup_district": q_merge_lookup_district,
        "conform_listings": q_conform_listings,
        "explode_listings": q_explode_listings,
        "rename_nested_density": q_rename_nested_density,
        "array_mean_embeddings": q_array_mean_embeddings,
        "reconcile_listings": q_reconcile_listings,
        "reconcile_basic": q_reconcile_basic,
        "canon_documents": q_canon_documents,
        "filter_project_orders": q_filter_project_orders,
        "feature_table": q_feature_table,
        "string_index_flags": q_string_index_flags,
        "regression_metrics": q_regression_metrics,
        "upsert_orders": q_upsert_orders,
        "hash_split_counts": q_hash_split_counts,
        "model_flag_means": q_model_flag_means,
        "predict_listings": q_predict_listings,
        "conflicting_listings": q_conflicting_listings,
        "kpi_imputed_random": q_kpi_imputed_random,
        "kpi_imputed_median": q_kpi_imputed_median,
        "lookup_files": q_lookup_files,
        "gbt_metrics": q_gbt_metrics,
        "kpi_stream": q_kpi_stream,
        "zones_kpis": q_zones_kpis,
        **catalog_jobs.queries(),
    }


def oracle_sql() -> dict:
    return {
        "kpi_table": SQL_KPI_TABLE,
        "kpi_imputed": SQL_KPI_IMPUTED,
        "kpi_imputed_constant": SQL_KPI_IMPUTED_CONSTANT,
        "dedup_listings": SQL_DEDUP_LISTINGS,
        "latest_order_per_customer": SQL_LATEST_ORDER_PER_CUSTOMER,
        "merge_lookup_neighborhood": SQL_MERGE_LOOKUP_NEIGHBORHOOD,
        "merge_lookup_district": SQL_MERGE_LOOKUP_DISTRICT,
        "conform_listings": SQL_CONFORM_LISTINGS,
        "explode_listings": SQL_EXPLODE_LISTINGS,
        "rename_nested_density": SQL_RENAME_NESTED_DENSITY,
        "array_mean_embeddings": SQL_ARRAY_MEAN_EMBEDDINGS,
        "reconcile_listings": SQL_RECONCILE_LISTINGS,
        "reconcile_basic": SQL_RECONCILE_BASIC,
        "canon_documents": SQL_CANON_DOCUMENTS,
        "filter_project_orders": SQL_FILTER_PROJECT_ORDERS,
        "feature_table": SQL_FEATURE_TABLE,
        "string_index_flags": SQL_STRING_INDEX_FLAGS,
        "regression_metrics": SQL_REGRESSION_METRICS,
        "upsert_orders": SQL_UPSERT_ORDERS,
        "hash_split_counts": SQL_HASH_SPLIT_COUNTS,
        "model_flag_means": SQL_MODEL_FLAG_MEANS,
        "predict_listings": SQL_PREDICT_LISTINGS,
        "conflicting_listings": SQL_CONFLICTING_LISTINGS,
        "kpi_imputed_random": SQL_KPI_IMPUTED_RANDOM,
        "kpi_imputed_median": SQL_KPI_IMPUTED_MEDIAN,
        "lookup_files": SQL_MERGE_LOOKUP_NEIGHBORHOOD,
        "kpi_stream": SQL_KPI_STREAM,
        "zones_kpis": SQL_ZONES_KPIS,
        **catalog_jobs.oracle_sql(),
    }
