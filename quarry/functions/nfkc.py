"""NFKC normalisation: the one text step Spark has no built-in for.

Only non-ASCII values are sent to Python: ASCII strings are NFKC-stable, so
the UDF receives null for them and the original value is kept.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _nfkc_batch(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def nfkc_column(x: Column) -> Column:
    non_ascii = F.when(x.rlike("[^\\x00-\\x7F]"), x)
    return F.coalesce(_nfkc_batch(non_ascii), x)
