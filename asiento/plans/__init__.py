"""Whole jobs made of the operators."""

from asiento.plans.batch import ExportError, RunConfig, run
from asiento.plans.report import run_report

__all__ = ["ExportError", "RunConfig", "run", "run_report"]
