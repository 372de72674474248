"""Geocoding: what is to be looked up, and what an answer says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import geo_point_valid

ANSWER = "array<struct<lat:string,lon:string,display_name:string,address:struct<city:string,town:string,village:string,country_code:string>>>"
BATCH = 50


def candidates(jobs: DataFrame, key: str, limit: int = BATCH) -> DataFrame:
    """Jobs that wait for coordinates, a batch of them in order of their key."""
    return jobs.filter(F.col("geocode_pending") & F.col("location_raw").isNotNull()).orderBy(key).limit(limit)


def addresses(jobs: DataFrame) -> DataFrame:
    """Each address once: a lookup costs a call."""
    return jobs.select(F.trim("location_raw").alias("address")).filter("address <> ''").distinct()


def answer(payload: Column, address: Column) -> Column:
    """Struct of lat, lng, formatted_address, city and country from a JSON answer; null if it has no point."""
    hit = F.get(F.from_json(payload, ANSWER), 0)
    lat, lng = hit["lat"].try_cast("double"), hit["lon"].try_cast("double")
    a = hit["address"]
    return F.when(geo_point_valid(lng, lat), F.struct(lat.alias("lat"), lng.alias("lng"), F.coalesce(hit["display_name"], address).alias("formatted_address"), F.coalesce(a["city"], a["town"], a["village"]).alias("city"), F.upper(a["country_code"]).alias("country")))


def apply_answers(jobs: DataFrame, answers: DataFrame) -> DataFrame:
    """Jobs with the coordinates of their address; ``answers`` has address and payload."""
    found = answers.select(F.col("address"), answer(F.col("payload"), F.col("address")).alias("_g")).filter("_g is not null")
    out = jobs.withColumn("address", F.trim("location_raw")).join(found, "address", "left").drop("address")
    point = F.struct(F.lit("Point").alias("type"), F.array("_g.lng", "_g.lat").alias("coordinates"))
    return out.withColumns({"location_geo": F.when(F.col("_g").isNotNull(), point), "city": F.col("_g.city"), "country": F.col("_g.country"), "formatted_address": F.col("_g.formatted_address"), "geocode_pending": F.col("geocode_pending") & F.col("_g").isNull()}).drop("_g")
