"""Company filings on Spark: read listings and stored pages, clean them, export typed tables."""

from asiento.operators import *  # noqa: F403
from asiento.operators import __all__ as _operators
from asiento.plans import ExportError, RunConfig, run, run_report
from asiento.sinks import *  # noqa: F403
from asiento.sinks import __all__ as _sinks
from asiento.sources import *  # noqa: F403
from asiento.sources import __all__ as _sources

__all__ = [*_operators, *_sinks, *_sources, "ExportError", "RunConfig", "run", "run_report"]
