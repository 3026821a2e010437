"""The weather table: its columns, types, value rules and code prefixes."""

from __future__ import annotations

from pyspark.sql import types as T

from kairoline.operators.contract import Field

TARGET = "load_shortfall_3h"

# Column names, text columns, rules and prefixes of the weather contract.
INDEX = "Unnamed: 0"
TIME = "time"
NUMBERS = (
    "Madrid_wind_speed Bilbao_wind_speed Barcelona_wind_speed Seville_wind_speed Valencia_wind_speed "
    "Bilbao_rain_1h Barcelona_rain_1h Seville_rain_1h Seville_rain_3h Barcelona_rain_3h Madrid_rain_1h "
    "Bilbao_snow_3h Valencia_snow_3h Seville_humidity Madrid_humidity Valencia_humidity "
    "Bilbao_clouds_all Seville_clouds_all Madrid_clouds_all "
    "Barcelona_pressure Bilbao_pressure Madrid_pressure Valencia_pressure "
    "Seville_temp Seville_temp_max Seville_temp_min Madrid_temp Madrid_temp_max Madrid_temp_min "
    "Bilbao_temp Bilbao_temp_min Bilbao_temp_max Barcelona_temp Barcelona_temp_max Barcelona_temp_min "
    "Valencia_temp Valencia_temp_max Valencia_temp_min "
    "Madrid_weather_id Barcelona_weather_id Bilbao_weather_id Seville_weather_id "
    "Barcelona_wind_deg Bilbao_wind_deg"
).split()
CODES = {"Valencia_wind_deg": "level_", "Seville_pressure": "sp"}
NON_NEGATIVE = ("Madrid_wind_speed", "Bilbao_wind_speed", "Barcelona_wind_speed", "Seville_wind_speed")
POSITIVE = ("Valencia_pressure", "Barcelona_pressure", "Bilbao_pressure", "Madrid_pressure")


def _rule(name: str) -> str | None:
    return "non_negative" if name in NON_NEGATIVE else "positive" if name in POSITIVE else None


CONTRACT = (
    Field(INDEX, "bigint", required=False),
    Field(TIME, "string"),
    *[Field(c, "string") for c in CODES],
    *[Field(c, "double", rule=_rule(c)) for c in NUMBERS],
    Field(TARGET, "double", required=False),
)

_SPARK = {"bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType()}
SCHEMA = T.StructType([T.StructField(f.name, _SPARK[f.type]) for f in CONTRACT])  # target last
FEATURES = T.StructType(SCHEMA.fields[:-1])
