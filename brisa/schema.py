"""Canonical schemas and fixed code lists."""

OBS = "fecha timestamp_ntz, pollutant string, id_est string, val double"
STATIONS = "id string, nombre string, lastyear int, lat double, lon double"
WX = "ts timestamp_ntz, var string, lat_idx int, lon_idx int, lat double, lon double, value double"
PARAMS = "kind string, name string, mean double, std double"
CLIM = "pollutant string, id_est string, month int, day int, hour int, val double"
FC = "model string, predicted_hour int, ts timestamp_ntz, station string, target double, pred double"
LOGS = "path string, content string"

# Observation codes, their chemical names, flag names, weather variables.
POLLUTANT_NAMES = {
    "otres": "O3", "pmco": "PMCO", "pmdoscinco": "PM2.5", "nox": "NOX", "codos": "CO2",
    "co": "CO", "nodos": "NO2", "no": "NO", "sodos": "SO2", "pmdiez": "PM10",
}
METEO_CODES = ["tmp", "rh", "wsp", "wdr", "pba"]
FLAGS = ["none", "row_avg", "last_day_same_hour", "climatology", "historical_avg", "missing"]
GRID_VARS = ["T2", "U10", "V10", "RAIN", "SWDOWN", "GLW", "RH", "WS10"]
AGGREGATE_STATIONS = ["min", "max", "mean"]

# Station codes and names.
STATION_NAMES = {
    "UIZ": "UAM Iztapalapa", "AJU": "Ajusco", "ATI": "Atizapan", "CUA": "Cuajimalpa",
    "SFE": "Santa Fe", "SAG": "San Agustín", "CUT": "Cuautitlán", "PED": "Pedregal",
    "TAH": "Tlahuac", "GAM": "Gustavo A. Madero", "IZT": "Iztacalco", "CCA": "ICAyCC - UNAM",
    "HGM": "Hospital General de México", "LPR": "La Presa", "MGH": "Miguel Hidalgo",
    "CAM": "Camarones", "FAC": "FES Acatlán", "TLA": "Tlalnepantla", "MER": "Merced",
    "XAL": "Xalostoc", "LLA": "Los Laureles", "TLI": "Tultitlán", "UAX": "UAM Xochimilco",
    "BJU": "Benito Juárez", "MPA": "Milpa Alta", "MON": "Montesillo", "NEZ": "Nezahualcóyotl",
    "INN": "Investigaciones Nucleares", "AJM": "Ajusco Medio", "VIF": "Villa de las Flores",
}
UNKNOWN_STATION = "Station ID not found"
