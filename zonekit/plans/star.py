"""Zone-shaped datasets derived by Spark from the star-schema test tables.

Roles: neighbourhood = nation, district = region, rental listing =
lineitem (located at its supplier's nation), income document = per-nation
yearly order statistics, density document = per-nation yearly shipment
statistics. Every dataset is a lazy plan over the given tables, so its work
grows with them; arrays are built only over domains with a fixed bound
(years, nations per region) or in bounded chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Line numbers per nested batch document built by ``listing_batches``.
BATCH_LINES = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def display_name(col) -> F.Column:
    """'NATION_7' -> 'Nation 7', 'MIDDLE EAST' -> 'Middle east'."""
    s = F.replace(col, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substr(s, F.lit(2))))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation with its region (joined on the region key)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select("n_nationkey", "n_name", "n_regionkey", "r_name"))


def supplier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> (nation name, region name)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = places(spark, sf_dir)
    return s.join(p, s.s_nationkey == p.n_nationkey).select("s_suppkey", "n_nationkey", "n_name", "r_name")


def listing_columns(li: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Listing attributes from lineitem columns (plain expressions)."""
    return li.select(
        *keep,
        F.col("l_orderkey").alias("_id"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("propertyCode"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        F.try_divide("l_extendedprice", "l_quantity").alias("priceByArea"),
        F.col("l_discount").alias("latitude"),
        F.col("l_tax").alias("longitude"),
        F.col("l_linenumber").alias("rooms"),
        (F.pmod("l_partkey", F.lit(3)) + 1).cast("int").alias("bathrooms"),
        F.pmod("l_suppkey", F.lit(10)).cast("int").alias("floor"),
        F.pmod(F.col("l_partkey") + F.col("l_suppkey"), F.lit(30)).cast("int").alias("numPhotos"),
        (F.col("l_returnflag") == "R").alias("exterior"),
        (F.col("l_linestatus") == "F").alias("has360"),
        (F.col("l_discount") >= 0.05).alias("has3DTour"),
        (F.col("l_tax") >= 0.04).alias("hasLift"),
        (F.col("l_quantity") >= 25).alias("hasPlan"),
        (F.month("l_shipdate") <= 6).alias("hasStaging"),
        (F.pmod("l_orderkey", F.lit(2)) == 0).alias("hasVideo"),
    )


def located(spark: SparkSession, sf_dir: str, lines: DataFrame, suppkey: str) -> DataFrame:
    """The lines with the nation and region of their supplier. One table after the other: Spark knows the
    size of a table, not that of a join, so while suppliers are few the lines stay where they are."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = places(spark, sf_dir)
    return (lines.join(s, lines[suppkey] == s.s_suppkey).join(p, s.s_nationkey == p.n_nationkey)
            .drop("s_suppkey", "s_nationkey", "n_regionkey"))


def listings(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None,
             places_of_suppliers: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Flat rental listings located at their supplier's nation/region
    (``places_of_suppliers``: a prepared ``supplier_places``, e.g. bucketed;
    ``keep``: further columns of ``lineitem``)."""
    li = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    lst = listing_columns(li, keep)
    if places_of_suppliers is not None:
        lst = lst.join(places_of_suppliers, lst.l_suppkey == places_of_suppliers.s_suppkey).drop("s_suppkey")
    else:
        lst = located(spark, sf_dir, lst, "l_suppkey")
    return (lst
            .withColumn("neighborhood_name", F.col("n_name"))
            .withColumn("district_name", F.col("r_name"))
            .withColumn("municipality", F.col("r_name")))


def noisy(col, variant) -> F.Column:
    """Four spellings of one upper-case place name: as is; lower case with
    spaces; precomposed accents with hyphens; decomposed accents with
    no-break spaces."""
    v0 = col
    v1 = F.lower(F.replace(col, F.lit("_"), F.lit(" ")))
    v2 = F.replace(F.replace(F.replace(col, F.lit("A"), F.lit("\u00c0")), F.lit("E"), F.lit("\u00c9")),
                   F.lit("_"), F.lit("-"))
    v3 = F.replace(F.replace(F.lower(col), F.lit("a"), F.lit("a\u0301")),
                   F.lit("_"), F.lit("\u00a0"))
    return (F.when(variant == 0, v0).when(variant == 1, v1)
            .when(variant == 2, v2).otherwise(v3))


def noisy_listings(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Listings whose place names come in four spellings (picked by key); ``keep``: further columns of ``lineitem``."""
    return noisy_names(listings(spark, sf_dir, lineitem, keep=keep))


def noisy_names(lst: DataFrame) -> DataFrame:
    """The place names of the listings in the spelling picked by their key."""
    variant = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(4))
    return (lst.withColumn("neighborhood_name", noisy(F.col("n_name"), variant))
            .withColumn("district_name", noisy(F.col("r_name"), variant)))


def _yearly_docs(parts: DataFrame, place_key: str, year_col: str, info_fields: list,
                 id_expr, district_id_expr, spark: SparkSession, sf_dir: str) -> DataFrame:
    per_year = parts.groupBy(place_key, year_col).agg(*info_fields)
    p = places(spark, sf_dir)
    docs = (per_year.join(p, per_year[place_key] == p.n_nationkey)
            .groupBy("n_nationkey", "n_name", "n_regionkey", "r_name")
            .agg(F.array_sort(F.collect_list(F.struct(*[c for c in per_year.columns
                                                         if c != place_key]))).alias("info")))
    return docs.select(id_expr.alias("_id"), F.col("n_name").alias("neigh_name "),
                       district_id_expr.alias("district_id"),
                       F.col("r_name").alias("district_name"), "info")


def income_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per nation: ``info[{year, pop, RFD}]`` with RFD = mean
    order value of the nation's customers that year.

    Orders join customer first (one shuffle of both by customer key; AQE
    splits a customer holding a large share of the orders), then the
    per-(nation, year) aggregate combines map-side to a few rows per task.
    Combining orders per (customer, year) before the join would not shrink
    them (customers far outnumber the rows of a task) and would add a
    second full shuffle."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .select("c_nationkey", F.year("o_orderdate").alias("year"), "o_totalprice"))
    info = [F.count(F.lit(1)).cast("int").alias("pop"), F.avg("o_totalprice").alias("RFD")]
    return _yearly_docs(j, "c_nationkey", "year", info, F.col("n_nationkey"),
                        F.col("n_regionkey"), spark, sf_dir)


def density_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per nation: ``info[{year, population, density(inh/ha),
    net_density (inh/ha)}]`` from shipped quantities of the nation's
    suppliers per ship year (lines join supplier first, as in
    ``income_docs``)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_discount")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(s, li.l_suppkey == s.s_suppkey)
         .select("s_nationkey", F.year("l_shipdate").alias("year"), "l_quantity",
                 (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("net_q")))
    info = [F.count(F.lit(1)).cast("double").alias("population"),
            F.avg("l_quantity").alias("density(inh/ha)"),
            F.avg("net_q").alias("net_density (inh/ha)")]
    return _yearly_docs(j, "s_nationkey", "year", info, F.col("n_nationkey").cast("string"),
                        F.col("n_regionkey").cast("string"), spark, sf_dir)


def batched_lines(li: DataFrame, lines: int = BATCH_LINES) -> DataFrame:
    """The given lines with the batch document they belong to (``_doc``, from ``l_orderkey`` and ``_chunk``),
    dealt by it: what is later grouped by document moves once, as the table's own short columns."""
    chunk = F.floor(F.col("l_linenumber") / F.lit(lines))
    doc = F.concat_ws(":", "l_orderkey", chunk)
    return li.repartition(doc).withColumn("_chunk", chunk).withColumn("_doc", doc)


def listing_batches(flat: DataFrame, item_cols: list, lines: int = BATCH_LINES) -> DataFrame:
    """Nest flat listing rows into batch documents ``(_id, value[])``: the
    lines of one order whose line numbers fall into one range of ``lines`` (rows that come
    from ``batched_lines`` have their document already).
    The documents follow from the rows' values, not from the file layout."""
    if "_doc" not in flat.columns:
        flat = batched_lines(flat, lines)
    return (flat.groupBy("_doc", "l_orderkey", "_chunk")
            .agg(F.collect_list(F.struct(*item_cols)).alias("value"))
            .select(F.col("_doc").alias("_id"), "value"))


def conflicting_batches(spark: SparkSession, sf_dir: str, copies: int = 2) -> DataFrame:
    """Batch documents per order and ship year, each of them twice (or ``copies`` = 1): copies of
    a listing (same order and line number) with different values meet in one
    batch or in several, and line 5 has no property code. The listings of a
    document are sorted, so positions follow from the data."""
    li = table(spark, sf_dir, "lineitem")
    item = F.struct(F.when(F.col("l_linenumber") != 5, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("propertyCode"),
                    F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("size"),
                    F.col("l_linenumber").alias("rooms"))
    # dealt first: with hardly a line or two per document, lists made before the shuffle only cost a sort
    lines = li.select(F.concat_ws(":", "l_orderkey", F.year("l_shipdate")).alias("_id"), item.alias("_item")).repartition("_id")
    docs = (lines.groupBy("_id")
            .agg(F.array_sort(F.collect_list("_item")).alias("value")))
    return docs.union(docs) if copies == 2 else docs


def neighborhood_lookups(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three neighbourhood lookup sources (long names; two with short names)
    that spell the same nations differently."""
    n = table(spark, sf_dir, "nation")
    nid = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    disp = display_name(F.col("n_name"))
    long_ = n.select(nid.alias("_id"), F.col("n_name").alias("neighborhood"),
                     F.lower(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("neighborhood_name"),
                     disp.alias("neighborhood_reconciled"))
    rent = n.select(nid.alias("_id"), F.replace("n_name", F.lit("_"), F.lit("-")).alias("ne"),
                    F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))).alias("ne_n"),
                    disp.alias("ne_re"))
    dens = n.select(nid.alias("_id"), F.replace("n_name", F.lit("A"), F.lit("\u00c0")).alias("ne"),
                    F.lower(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("ne_n"),
                    F.concat(disp, F.lit(", Zone")).alias("ne_re"))
    return [long_, rent, dens]


def district_lookups(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three district lookup sources with the region's nation ids (an array
    bounded by the fixed nation dimension)."""
    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation")
    members = (n.groupBy("n_regionkey")
               .agg(F.array_sort(F.collect_list(F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))))
                    .alias("ids")))
    rr = r.join(members, r.r_regionkey == members.n_regionkey, "left")
    rid = F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
    disp = display_name(F.col("r_name"))
    long_ = rr.select(rid.alias("_id"), F.col("r_name").alias("district"),
                      F.lower("r_name").alias("district_name"), disp.alias("district_reconciled"),
                      F.col("ids").alias("neighborhood_id"))
    rent = rr.select(rid.alias("_id"), F.replace("r_name", F.lit(" "), F.lit("-")).alias("di"),
                     F.lower(F.replace("r_name", F.lit(" "), F.lit("-"))).alias("di_n"),
                     disp.alias("di_re"), F.col("ids").alias("ne_id"))
    dens = rr.select(rid.alias("_id"), F.replace("r_name", F.lit("E"), F.lit("\u00c9")).alias("di"),
                     F.lower("r_name").alias("di_n"), F.concat(disp, F.lit(" district")).alias("di_re"),
                     F.col("ids").alias("ne_id"))
    return [long_, rent, dens]


def zone_inputs(spark: SparkSession, sf_dir: str):
    """Landing-zone collections for the whole zone job: rental batch
    documents with noisy place names, income and density documents, and
    the three district / neighbourhood lookup sources."""
    from zonekit.plans.zones import ZoneInputs

    # sorted while they are short: grouping by document and removing copies of documents then sort no more
    lines = located(spark, sf_dir, batched_lines(table(spark, sf_dir, "lineitem")), "l_suppkey").sortWithinPartitions("_doc", "l_orderkey", "_chunk")
    lst = noisy_names(listing_columns(lines, keep=["_doc", "_chunk", "n_name", "r_name"])).withColumns({"municipality": F.col("r_name"),
        "propertyCode": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                    "price", "latitude", "longitude", "size")})
    item = ["propertyCode", F.col("neighborhood_name").alias("neighborhood"), "district_name",
            "municipality", "price", "size", "priceByArea", "latitude", "longitude", "rooms",
            "bathrooms", "floor", "numPhotos", "exterior", "has360", "has3DTour", "hasLift",
            "hasPlan", "hasStaging", "hasVideo"]
    return ZoneInputs(rentals=listing_batches(lst, item), income=income_docs(spark, sf_dir),
                      density=density_docs(spark, sf_dir),
                      district_lookups=district_lookups(spark, sf_dir),
                      neighborhood_lookups=neighborhood_lookups(spark, sf_dir))
