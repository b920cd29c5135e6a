"""HTML entity unescape, the one normalization step without a built-in expression."""

from __future__ import annotations

from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.StringType())
def _unescape_batch(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unescape(t) for t in text.to_pylist()], pa.string())


def unescape_entities(text: Column) -> Column:
    """Replace all HTML5 entities.

    Only texts holding an ampersand are sent to Python; the others pass as null and
    come back through ``coalesce``.
    """
    suspect = F.when(F.contains(text, F.lit("&")), text)
    return F.coalesce(_unescape_batch(suspect), text)
