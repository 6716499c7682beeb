"""The observation record: its fields, sentinels, codes and scales."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names in message and CSV order.
FIELDS = [
    "station",
    "valid",
    "tmpf",
    "dwpf",
    "relh",
    "feel",
    "drct",
    "sped",
    "alti",
    "mslp",
    "p01m",
    "vsby",
    "skyc1",
    "skyl1",
    "wxcodes",
    "ice_acceretion_1hr",
]

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS])

# The code a sky cover is replaced by.
SKY_CODES = {"CLR": 0, "VV": 1, "SCT": 2, "FEW": 3, "OVC": 4, "BKN": 5}

# The code a station is replaced by.
STATION_CODES = {
    "CDA": 0,
    "EFK": 1,
    "FSO": 2,
    "MVL": 3,
    "RUT": 4,
    "MPV": 5,
    "VSF": 6,
    "DDH": 7,
    "1V4": 8,
    "BTV": 9,
    "6B0": 10,
}

# The text that marks a missing reading, and what replaces it.
MISSING_TEXT = "M"
MISSING_PRESSURE = -1
REPLACEMENTS = {
    "mslp": "0",
    "skyl1": "0",
    "wxcodes": "88",
    "ice_acceretion_1hr": "0",
    "skyc1": "CLR",
}

# Divisors of the measured columns.
DIVISORS = {
    "tmpf": 100,
    "dwpf": 100,
    "relh": 100,
    "drct": 100,
    "sped": 100,
    "feel": 100,
    "alti": 100,
    "vsby": 100,
    "skyl1": 100,
    "mslp": 1000,
}

# Fixed value: the key every published message carries.
MESSAGE_KEY = "dummykey"
