"""The whole job: landing zone -> formatted zone -> exploitation zone.

Formatted zone (one lazy chain per published table, written once):
  lookups   - district / neighbourhood sources in either naming, merged by
              priority, conformed; alias tables for reconciliation
  sources   - rentals, income, density: de-duplicated on the document key,
              conformed to the declared schema by name, renamed, rentals
              flattened to one row per listing, place names reconciled,
              de-duplicated on the row key
Exploitation zone:
  kpis         - per-neighbourhood KPI table (key: reconciled name)
  model_table  - listings x income x density
  model        - fitted pipeline (indexers + assembler + GBT), saved whole
  model_metrics- RMSE/MAE/MSE/R2 on the held-out split

Every table is written under ``root`` (default: a fresh folder below the
shared ``spark.checkpoint.dir``); later steps read the written tables, which
also cuts lineage before the iterative model fit.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.operators.conform import conform
from zonekit.operators.dedup import dedup, merge_by_priority
from zonekit.operators.model import build_pipeline, hash_split, prepare_features, regression_metrics
from zonekit.operators.model import save_model, score, train
from zonekit.operators.nested import explode_rows, has_array_of_structs
from zonekit.operators.reconcile import alias_table, reconcile
from zonekit.operators.rename import merge_synonyms, rename_columns, trim_column_names
from zonekit.plans.features import LISTING_COLUMNS, feature_table
from zonekit.plans.kpi import kpi_table
from zonekit.schemas import (DISTRICT_RENAMES, NEIGHBORHOOD_RENAMES, density_schema, income_schema,
                             listing_schema, lookup_district_schema, lookup_neighborhood_schema,
                             parse, rentals_schema, rentals_source_schema)
from zonekit.session import WRITE_CONF, scratch_path, settings
from zonekit.sinks.pointer import current, current_number, publish

DISTRICT_NAME_COLS = ["district", "district_name", "district_reconciled"]
NEIGHBORHOOD_NAME_COLS = ["neighborhood", "neighborhood_name", "neighborhood_reconciled"]
# The source name columns renamed to the common key.
INCOME_RENAMES = {"neigh_name ": "neighborhood_name"}
DENSITY_RENAMES = {"neigh_name ": "neighborhood_name"}


@dataclass
class ZoneInputs:
    """Landing-zone DataFrames (already read; see ``read_landing``)."""
    rentals: DataFrame
    income: DataFrame
    density: DataFrame
    district_lookups: Sequence[DataFrame]       # priority order
    neighborhood_lookups: Sequence[DataFrame]   # priority order


@dataclass
class ZoneConfig:
    root: str | None = None
    reconcile_mode: str = "canon"
    key: str = "neigh_name_reconciled"
    # de-duplication key of reconciled listings; "_id" (the batch key)
    # reproduces the reference's cardinality of one listing per batch
    listing_key: str = "propertyCode"
    # column of the batch documents by which the newest copy of a listing is
    # found (largest value); None: the batch id itself, for ids that sort in time
    batch_order: str | None = None
    municipality: str | None = None
    impute_strategy: str = "none"
    impute_value: float | None = None
    train_percent: int = 75
    gbt_overrides: dict = field(default_factory=dict)
    steps: Sequence[str] = ("formatted", "kpis", "model")


def read_landing(spark: SparkSession, rentals, income, density, district_lookups, neighborhood_lookups,
                 fmt: str = "json") -> ZoneInputs:
    """Read the landing collections with declared schemas (no inference
    pass). Rentals may be batch documents (a ``value`` array) or one listing per
    row: both shapes are read, and ``formatted_zone`` sorts them apart. Each source is a path, or a spec ``{"format": ..., "path": ...,
    "options": {...}}`` for a connector that is configured by options (e.g.
    a document-store connector on the classpath)."""
    from zonekit.schemas import LOOKUP_DISTRICT_SOURCE_DDL

    def rd(src, schema):
        spec = src if isinstance(src, dict) else {"path": src}
        f = spec.get("format", fmt)
        r = spark.read.format(f).options(**spec.get("options", {}))
        # declared schema unless the format carries its own ("schema": bool overrides)
        if spec.get("schema", f not in ("parquet", "orc")):
            r = r.schema(schema)
        return r.load(spec["path"]) if spec.get("path") else r.load()

    return ZoneInputs(
        rentals=rd(rentals, rentals_source_schema()),
        income=rd(income, income_schema()),
        density=rd(density, density_schema()),
        district_lookups=[rd(p, parse(LOOKUP_DISTRICT_SOURCE_DDL)) for p in district_lookups],
        neighborhood_lookups=[rd(p, lookup_neighborhood_schema()) for p in neighborhood_lookups])


def _write(df: DataFrame, path: str) -> DataFrame:
    with settings(df.sparkSession, WRITE_CONF):
        df.write.mode("overwrite").parquet(path, compression="zstd")
    return df.sparkSession.read.parquet(path)


def flat_listings(raw: DataFrame, batch_order: str | None = None, unique: bool = False) -> DataFrame:
    """One row per listing, ``_id`` (batch), the listing columns, ``_order``
    and ``_place`` (position in its batch), from batch documents, flat rows
    or a mixture of both. Copies of a batch document (same ``_id``)
    count once; a document without ``_id`` is no copy of another. ``unique``: there are no copies, so none are looked for."""
    raw = trim_column_names(raw)
    order = F.col(f"`{batch_order or '_id'}`").cast("string").alias("_order")
    listing = listing_schema()
    parts = []
    if has_array_of_structs(raw, "value"):
        schema = T.StructType([*rentals_schema().fields, T.StructField("_order", T.StringType())])
        docs = conform(raw.withColumn("_order", order), schema, required=["_id"]).where(F.col("value").isNotNull())
        if not unique:
            known = dedup(docs.where(F.col("_id").isNotNull()), "_id", ["_order"], descending=bool(batch_order))
            docs = known.unionByName(docs.where(F.col("_id").isNull()))
        parts.append(explode_rows(docs, "value", keep=["_id", "_order"], position="_place")
                     .select("_id", "_order", "_place", *listing.fieldNames()))
        flat = raw.where(F.col("value").isNull()) if set(listing.fieldNames()) & set(raw.columns) else None
    else:
        flat = raw
    if flat is not None:
        names = T.StructType([T.StructField("_id", T.StringType()), *listing.fields])
        parts.append(conform(flat.withColumn("_order", order), T.StructType([*names.fields, T.StructField("_order", T.StringType())]),
                             required=["_id", "propertyCode"])
                     .withColumn("_place", F.lit(0)).select("_id", "_order", "_place", *listing.fieldNames()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def newest_listings(listings: DataFrame, listing_key: str = "propertyCode") -> DataFrame:
    """One row per listing: that of the newest batch (``_order``, then batch
    id; ties by the whole row). A listing without key is known by batch and
    position, so it collapses with nothing else."""
    if listing_key == "_id":
        return dedup(listings, "_id", ["propertyCode", "_place"]).drop("_order", "_place")
    # rows move as they are and are sorted once, after that; listings without key in the same pass, spread by a digest
    no_key = F.col(listing_key).isNull()
    digest = F.when(no_key, F.xxhash64(*[F.col(f"`{c}`") for c in listings.columns]))
    rest = [c for c in listings.columns if c not in (listing_key, "_order", "_id", "_place")]
    newest = Window.partitionBy(listing_key, "_digest").orderBy(*[F.col(f"`{c}`").desc() for c in ("_order", "_id", "_place", *rest)])
    ranked = listings.withColumn("_digest", digest).withColumn("_newest", F.row_number().over(newest))
    return ranked.where(no_key | (F.col("_newest") == 1)).drop("_digest", "_newest", "_order", "_place")


def formatted_zone(spark: SparkSession, inp: ZoneInputs, root: str, mode: str = "canon",
                   listing_key: str = "propertyCode", batch_order: str | None = None) -> dict:
    out = {}
    dl = [merge_synonyms(d, DISTRICT_RENAMES) for d in inp.district_lookups]
    nl = [merge_synonyms(n, NEIGHBORHOOD_RENAMES) for n in inp.neighborhood_lookups]
    dmerged = _write(conform(merge_by_priority(dl, "_id"), lookup_district_schema()),
                     f"{root}/formatted/lookup_district")
    nmerged = _write(conform(merge_by_priority(nl, "_id"), lookup_neighborhood_schema()).drop(
        "ne", "ne_n", "ne_re"), f"{root}/formatted/lookup_neighborhood")
    if mode == "canon":
        dal = alias_table([(d, DISTRICT_NAME_COLS) for d in dl], display=dmerged,
                          display_col="district_reconciled")
        nal = alias_table([(n, NEIGHBORHOOD_NAME_COLS) for n in nl], display=nmerged,
                          display_col="neighborhood_reconciled")
    else:
        dal = dmerged.select(F.col("district_name").alias("alias"), F.col("_id").alias("id"),
                             F.col("district_reconciled").alias("reconciled"))
        nal = nmerged.select(F.col("neighborhood_name").alias("alias"), F.col("_id").alias("id"),
                             F.col("neighborhood_reconciled").alias("reconciled"))
    dal = _write(dal, f"{root}/formatted/alias_district")
    nal = _write(nal, f"{root}/formatted/alias_neighborhood")
    out.update(lookup_district=f"{root}/formatted/lookup_district",
               lookup_neighborhood=f"{root}/formatted/lookup_neighborhood",
               alias_district=f"{root}/formatted/alias_district",
               alias_neighborhood=f"{root}/formatted/alias_neighborhood")

    def place(df):
        # the alias tables are written tables already: no re-materialisation
        r = reconcile(df, "district_name", dal, "district_reconciled", "district_lookup_id", mode=mode,
                      materialize=False)
        return reconcile(r, "neighborhood_name", nal, "neigh_name_reconciled", "neighborhood_lookup_id",
                         mode=mode, materialize=False)

    # copies go before names are reconciled: discarded rows are not normalised
    listings = newest_listings(flat_listings(inp.rentals, batch_order), listing_key)
    _write(place(listings.withColumnRenamed("neighborhood", "neighborhood_name")), f"{root}/formatted/rentals_reconciled")

    for name, df, schema, ren in (("income", inp.income, income_schema(), INCOME_RENAMES),
                                  ("density", inp.density, density_schema(), DENSITY_RENAMES)):
        typed, absent = rename_columns(conform(dedup(trim_column_names(df), "_id"), schema, required=list(ren)), ren)
        if absent:
            raise ValueError(f"{name}: columns {absent} are missing")
        _write(place(typed), f"{root}/formatted/{name}_reconciled")
    out.update({f"{n}_reconciled": f"{root}/formatted/{n}_reconciled"
                for n in ("rentals", "income", "density")})
    return out


def exploitation_zone(spark: SparkSession, formatted: dict, root: str, cfg: ZoneConfig) -> dict:
    out = {}
    rentals = spark.read.parquet(formatted["rentals_reconciled"])
    income = spark.read.parquet(formatted["income_reconciled"])
    density = spark.read.parquet(formatted["density_reconciled"])
    if "kpis" in cfg.steps:
        k = kpi_table(rentals, income, density, key=cfg.key, impute_strategy=cfg.impute_strategy,
                      impute_value=cfg.impute_value)
        _write(k, f"{root}/exploitation/kpis")
        out["kpis"] = f"{root}/exploitation/kpis"
    if "model" in cfg.steps:
        ft = feature_table(rentals, income, density, key=cfg.key, municipality=cfg.municipality,
                           listing_columns=LISTING_COLUMNS + ["propertyCode"])
        ft = _write(ft, f"{root}/exploitation/model_table")
        df = prepare_features(ft)
        tr, te = hash_split(df, ["propertyCode"], cfg.train_percent)
        model = train(tr, build_pipeline(**cfg.gbt_overrides))
        save_model(model, f"{root}/exploitation/model")
        _write(regression_metrics(score(model, te)), f"{root}/exploitation/model_metrics")
        out.update(model_table=f"{root}/exploitation/model_table", model=f"{root}/exploitation/model",
                   model_metrics=f"{root}/exploitation/model_metrics")
    return out


FORMATTED_TABLES = ("lookup_district", "lookup_neighborhood", "alias_district", "alias_neighborhood",
                    "rentals_reconciled", "income_reconciled", "density_reconciled")


def run_zones(spark: SparkSession, inputs: ZoneInputs | None, cfg: ZoneConfig | None = None) -> dict:
    """Run the configured steps; returns the paths of the written tables.
    Without the ``formatted`` step the formatted tables already under
    ``cfg.root`` are used (``inputs`` may then be None)."""
    cfg = cfg or ZoneConfig()
    if "formatted" not in cfg.steps and not cfg.root:
        raise ValueError("without the 'formatted' step, root must name an existing zone folder")
    root = (cfg.root or scratch_path(spark, "zones", uuid.uuid4().hex)).rstrip("/")
    if "formatted" in cfg.steps:
        formatted = formatted_zone(spark, inputs, root, cfg.reconcile_mode, cfg.listing_key, cfg.batch_order)
    else:
        formatted = {t: f"{root}/formatted/{t}" for t in FORMATTED_TABLES}
    return {**formatted, **exploitation_zone(spark, formatted, root, cfg)}


def run_zones_versioned(spark: SparkSession, inputs: ZoneInputs | None, cfg: ZoneConfig) -> dict:
    """``run_zones`` into a new folder below ``cfg.root``, published as one state by an atomic
    pointer when every step is done: readers (``current_zones``) see the tables of the run before or
    those of this run, also if it dies halfway or another job runs beside it (the
    later of two jobs that began from one state fails). Without the ``formatted`` step the published formatted
    tables are used and stay part of the state."""
    if not cfg.root:
        raise ValueError("a versioned run needs a root folder")
    root = cfg.root.rstrip("/")
    number = current_number(spark, root)
    before = current(spark, root, number) or {}
    own = replace(cfg, root=f"{root}/runs/{uuid.uuid4().hex}")
    if "formatted" in cfg.steps:
        paths = run_zones(spark, inputs, own)
    else:
        lost = [t for t in FORMATTED_TABLES if t not in before]
        if lost:
            raise ValueError(f"{root}: no formatted tables are published ({lost})")
        formatted = {t: before[t] for t in FORMATTED_TABLES}
        paths = {**formatted, **exploitation_zone(spark, formatted, own.root, own)}
    publish(spark, root, paths, after=number)
    return paths


def current_zones(spark: SparkSession, root: str, number: int | None = None) -> dict:
    """Paths of the tables last published under ``root`` (or as of a number); empty before the first run."""
    return current(spark, root.rstrip("/"), number) or {}
