"""Yes/no answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asiento.functions.text import as_column


def es_bool(c: Column | str) -> Column:
    """``Si`` or ``Sí`` -> true, ``No`` -> false, all else (other case, blank) -> null."""
    c = as_column(c)
    return F.when(c.isin("Si", "Sí"), F.lit(True)).when(c == "No", F.lit(False))
