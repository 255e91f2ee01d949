"""Declared schemas of the tables and of the landed JSON."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def columns(spec: str) -> T.StructType:
    """``"a b c:double"`` -> StructType; a column without a type is a string."""
    fields = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "string"]))
    return T.StructType(fields)


def nested(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


COMPANIES_RAW = columns("cr_no name_zh name_en address_raw fetched_at:timestamp")

SNAPSHOT = columns(
    "cr_no name_zh name_en address_raw company_type date_of_incorporation "
    "re_domiciliation_date fetched_at:timestamp"
)

GEOCODE_FIELDS = columns(
    "geo_address score:double region district street_name building_name "
    "latitude:double longitude:double"
)

ADDRESS_CACHE = columns(
    "address_hash address_clean als_json geo_address score:double region district street_name "
    "building_name latitude:double longitude:double manual_review:boolean fetched_at:timestamp"
)

MASTER = columns(
    "cr_no name_zh name_en address_raw address_clean geo_address region district street_name "
    "building_name latitude:double longitude:double confidence:double manual_review:boolean "
    "company_type date_of_incorporation re_domiciliation_date last_updated:timestamp"
)

TAG_COLUMNS = columns(
    "industry_tag industry_name_zh industry_name_en industry_method industry_conf:double "
    "industry_review:boolean"
)

MASTER_TAGGED = T.StructType(MASTER.fields + TAG_COLUMNS.fields)

SCAN_QUEUE = columns("brn status queried_at:timestamp batch_id")

INDUSTRY_CODES = columns("code level:int name_zh name_en parent_code")

ADDRESS_SAMPLES = columns("raw_address expected_district")

REQUIRED_COLUMNS = ("cr_no", "name_zh", "name_en", "address_raw")
EXTRA_COLUMNS = ("company_type", "date_of_incorporation", "re_domiciliation_date")

REGISTRY_RECORD = columns(
    "Brn Chinese_Company_Name English_Company_Name Address_of_Registered_Office Company_Type "
    "Date_of_Incorporation Re-domiciliation_Date"
)

CODE_ITEM = columns("code sic_code name_zh name_c name_en name_e level parent_code")

_PREMISES = nested(
    ChiRegion=T.StringType(),
    EngRegion=T.StringType(),
    ChiDistrictBlock=columns("ChiDistrict EngDistrict"),
    EngDistrictBlock=columns("ChiDistrict EngDistrict"),
    StreetBlock=columns("ChiStreetName EngStreetName"),
    BuildingBlock=columns("ChiBuildingName EngBuildingName"),
)

# `_malformed` receives the text when any part of it has another shape than declared.
GEOCODE_RESPONSE = nested(
    SuggestedAddress=T.ArrayType(
        nested(
            Address=nested(
                PremisesAddress=nested(
                    GeoAddress=T.StringType(),
                    ChiPremisesAddress=_PREMISES,
                    EngPremisesAddress=_PREMISES,
                    GeospatialInformation=columns("Latitude Longitude"),
                )
            ),
            ValidationInformation=columns("Score"),
        )
    ),
    _malformed=T.StringType(),
)
