"""Declared schemas of the zone datasets.

Fixed values: field names and types of the reference's collections
(lookups in long and short naming, rental listings batch documents, income
and density documents), as DDL text in declaration order.
"""

from __future__ import annotations

from pyspark.sql import types as T

LOOKUP_NEIGHBORHOOD_DDL = (
    "_id STRING, neighborhood STRING, neighborhood_name STRING, neighborhood_reconciled STRING, "
    "ne STRING, ne_n STRING, ne_re STRING")

LOOKUP_DISTRICT_DDL = (
    "_id STRING, district STRING, district_name STRING, district_reconciled STRING, "
    "neighborhood_id ARRAY<STRING>")

# Superset used to read district lookup sources in either naming.
LOOKUP_DISTRICT_SOURCE_DDL = LOOKUP_DISTRICT_DDL + (
    ", di STRING, di_n STRING, di_re STRING, ne_id ARRAY<STRING>")

LISTING_DDL = (
    "address STRING, bathrooms INT, country STRING, "
    "detailedType STRUCT<subTypology: STRING, typology: STRING>, distance STRING, "
    "district_name STRING, exterior BOOLEAN, externalReference STRING, floor INT, "
    "has360 BOOLEAN, has3DTour BOOLEAN, hasLift BOOLEAN, hasPlan BOOLEAN, hasStaging BOOLEAN, "
    "hasVideo BOOLEAN, latitude DOUBLE, longitude DOUBLE, municipality STRING, "
    "neighborhood STRING, newDevelopment BOOLEAN, newDevelopmentFinished BOOLEAN, "
    "numPhotos INT, operation STRING, "
    "parkingSpace STRUCT<hasParkingSpace: BOOLEAN, isParkingSpaceIncludedInPrice: BOOLEAN, "
    "parkingSpacePrice: DOUBLE>, price DOUBLE, priceByArea DOUBLE, propertyCode STRING, "
    "propertyType STRING, province STRING, rooms INT, showAddress BOOLEAN, size DOUBLE, "
    "status STRING, suggestedTexts STRUCT<subtitle: STRING, title: STRING>, thumbnail STRING, "
    "topNewDevelopment BOOLEAN, url STRING")

INCOME_DDL = (
    "_id INT, `neigh_name ` STRING, district_id INT, district_name STRING, "
    "info ARRAY<STRUCT<year: INT, pop: INT, RFD: DOUBLE>>")

DENSITY_DDL = (
    "_id STRING, `neigh_name ` STRING, district_id STRING, district_name STRING, "
    "info ARRAY<STRUCT<year: INT, population: DOUBLE, `density(inh/ha)`: DOUBLE, "
    "`net_density (inh/ha)`: DOUBLE>>")

# Column renames of the reference (short lookup names -> long
# names; source name columns -> the common key).
DISTRICT_RENAMES = {"di": "district", "di_n": "district_name", "di_re": "district_reconciled",
                    "ne_id": "neighborhood_id"}
NEIGHBORHOOD_RENAMES = {"ne": "neighborhood", "ne_n": "neighborhood_name",
                        "ne_re": "neighborhood_reconciled"}


def parse(ddl: str) -> T.StructType:
    """DDL text -> ``StructType``."""
    t = T.DataType.fromDDL(ddl)
    if not isinstance(t, T.StructType):
        raise ValueError("not a struct DDL")
    return t


def listing_schema() -> T.StructType:
    return parse(LISTING_DDL)


def rentals_schema() -> T.StructType:
    return T.StructType([T.StructField("_id", T.StringType()),
                         T.StructField("value", T.ArrayType(listing_schema()))])


def rentals_source_schema() -> T.StructType:
    """Superset used to read rentals that are batch documents or flat rows."""
    return T.StructType([*rentals_schema().fields, *listing_schema().fields])


def income_schema() -> T.StructType:
    return parse(INCOME_DDL)


def density_schema() -> T.StructType:
    return parse(DENSITY_DDL)


def lookup_neighborhood_schema() -> T.StructType:
    return parse(LOOKUP_NEIGHBORHOOD_DDL)


def lookup_district_schema() -> T.StructType:
    return parse(LOOKUP_DISTRICT_DDL)
