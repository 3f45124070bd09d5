"""Spark-native analytics for hourly air-quality panels, weather grids and forecast checks."""

from brisa.session import build_session, prepare, settle, work_path

__all__ = ["build_session", "prepare", "settle", "work_path"]
