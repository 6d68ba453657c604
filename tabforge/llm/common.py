"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The separators ``[\x20\x09-\x0D]``.  ``bytes.split()``, ``bytes.strip()`` and ``bytes.lower()``
#: know exactly these and exactly A-Z, so byte code needs no pattern.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(array):
    """UTF-8 bytes of an Arrow string array, row by row, without decoding (null: empty)."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    for value in array.cast(kind):
        yield value.as_py() or b""
