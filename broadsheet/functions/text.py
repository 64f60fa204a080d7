"""Text expressions: stripping, letter filters, Unicode normal forms."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` cuts plain spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def without_letters(c: Column, letters: str) -> Column:
    return F.translate(c, letters, "")


@F.pandas_udf(T.StringType())
def _normal_form(texts: pd.Series, form: pd.Series) -> pd.Series:
    return texts.str.normalize(form.iloc[0]) if len(texts) else texts


def normal_form(c: Column, form: str = "NFC") -> Column:
    """The text in a Unicode normal form; Spark has no function for it, so Arrow batches go to Python."""
    return _normal_form(c, F.lit(form))
