"""Geocoder response text -> address fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.keys import non_empty
from rollbook.schemas import GEOCODE_FIELDS, GEOCODE_RESPONSE


# A Java double takes suffixes (85f, 1d) and hexadecimal forms that are no numbers here.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _number(text: Column) -> Column:
    """The number that a text is, else null."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def geocode_document(response: Column) -> Column:
    """The answer as a struct; text of another shape is kept in its ``_malformed`` field."""
    return F.from_json(response, GEOCODE_RESPONSE, {"columnNameOfCorruptRecord": "_malformed"})


def geocode_fields(doc: Column) -> Column:
    """A struct of the eight address fields of the first suggestion of a parsed answer.

    The zh block is used whenever it is present, the en block only without it; inside a block an
    empty zh value falls back to the en value. A response that is not JSON, has another shape, no
    suggestion or a score that is no number gives the empty record: score 0, everything else null.
    """
    top = F.get(doc["SuggestedAddress"], F.lit(0))
    premises = top["Address"]["PremisesAddress"]
    block = F.coalesce(premises["ChiPremisesAddress"], premises["EngPremisesAddress"])
    area = F.coalesce(block["ChiDistrictBlock"], block["EngDistrictBlock"])
    score_text = top["ValidationInformation"]["Score"]
    score = _number(F.coalesce(score_text, F.lit("0")))

    def zh_else_en(parent: Column, zh: str, en: str) -> Column:
        return F.coalesce(non_empty(parent[zh]), parent[en])

    values = {
        "geo_address": premises["GeoAddress"],
        "score": score,
        "region": zh_else_en(block, "ChiRegion", "EngRegion"),
        "district": zh_else_en(area, "ChiDistrict", "EngDistrict"),
        "street_name": zh_else_en(block["StreetBlock"], "ChiStreetName", "EngStreetName"),
        "building_name": zh_else_en(block["BuildingBlock"], "ChiBuildingName", "EngBuildingName"),
        "latitude": _number(premises["GeospatialInformation"]["Latitude"]),
        "longitude": _number(premises["GeospatialInformation"]["Longitude"]),
    }
    usable = top.isNotNull() & doc["_malformed"].isNull() & score.isNotNull()
    found = F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in GEOCODE_FIELDS])
    empty = F.struct(
        *[
            F.lit(0.0 if f.name == "score" else None).cast(f.dataType).alias(f.name)
            for f in GEOCODE_FIELDS
        ]
    )
    return F.when(usable, found).otherwise(empty)
