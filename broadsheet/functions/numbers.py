"""Numbers: rounding that does not depend on how a double is written in decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column | str, digits: int = 6) -> Column:
    """``c`` as a double at so many digits, halves away from zero, by scaling: as C's ``round`` does. NULL stays NULL."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    scale = float(10**digits)
    return F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / scale
