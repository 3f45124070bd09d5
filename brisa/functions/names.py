"""Parsing of series, file and run names, and lookups keyed by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brisa.functions.clock import month_folder
from brisa.schema import STATION_NAMES, UNKNOWN_STATION

# File-name markers and the tables they feed; the first marker found wins.
PARAM_TABLES = [
    ("PM2.5", "cont_pmdoscinco"), ("PM10", "cont_pmdiez"), ("NOX", "cont_nox"), ("CO2", "cont_codos"),
    ("PMCO", "cont_pmco"), ("CO", "cont_co"), ("NO2", "cont_nodos"), ("NO", "cont_no"), ("O3", "cont_otres"),
    ("SO2", "cont_sodos"), ("TMP", "met_tmp"), ("RH", "met_rh"), ("WSP", "met_wsp"), ("WDR", "met_wdr"),
    ("PBA", "met_pba"),
]
# Name patterns.
WRF_FILE = r"wrfout_(d\d\d)_(\d{4}-\d{2}-\d{2})_(\d{2})"
RUN_NAME = r"\d{4}_\d{6}"


def param_table(name: Column) -> Column:
    out = F.when(name.contains(PARAM_TABLES[0][0]), F.lit(PARAM_TABLES[0][1]))
    for marker, table in PARAM_TABLES[1:]:
        out = out.when(name.contains(marker), F.lit(table))
    return out


def series_pollutant(series: Column) -> Column:
    """Second last part of ``[prefix_]cont_<pollutant>_<station>``."""
    return F.element_at(F.split(series, "_"), -2)


def series_station(series: Column) -> Column:
    return F.element_at(F.split(series, "_"), -1)


def series_name(pollutant: Column, station: Column) -> Column:
    return F.concat_ws("_", F.lit("cont"), pollutant, station)


def strip_lead(name: Column) -> Column:
    """``plus_05_cont_otres_X`` -> ``cont_otres_X``."""
    return F.regexp_replace(name, r"^[^_]+_[^_]+_", "")


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def forecast_hour(path: Column) -> Column:
    """Horizon in ``forecast_<h>.csv``; otherwise the last ``_`` part when it is a number."""
    stem = file_stem(path)
    named = F.regexp_extract(stem, r"forecast_(\d+)$", 1)
    tail = F.regexp_extract(stem, r"_?(\d+)$", 1)
    return F.coalesce(F.nullif(named, F.lit("")), F.nullif(tail, F.lit(""))).cast("int")


def model_prefix(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*?)-epoch", 1)


def wrf_parts(path: Column) -> dict[str, Column]:
    return {
        "domain": F.regexp_extract(path, WRF_FILE, 1),
        "day": F.regexp_extract(path, WRF_FILE, 2),
        "hour": F.regexp_extract(path, WRF_FILE, 3),
    }


def month_dir(ts: Column) -> Column:
    return month_folder(F.month(ts))


def station_table(spark) -> DataFrame:
    return spark.createDataFrame(list(STATION_NAMES.items()), "id string, nombre string")


def station_label(code: Column) -> Column:
    """Name of a code, from the fixed list; the default text for any other."""
    pairs = F.create_map(*[F.lit(x) for kv in STATION_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, code), F.lit(UNKNOWN_STATION))
