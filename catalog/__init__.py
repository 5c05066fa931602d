"""Every registered query beside its SQL oracle, bound to the driver's tables."""

from catalog import bronze_cases, forecast_cases, incremental_cases, mart_cases, plan_cases, run_cases, text_cases, view_cases  # noqa: F401
from catalog.base import CASES

__all__ = ["CASES"]
