"""Compressed text payloads."""

from __future__ import annotations

import sys
import zlib

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Workers get these helpers with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the one encoding that carries text.
ZLIB = "zlib"


def inflate_one(data: bytes | None, encoding: str | None) -> str | None:
    """One payload's text."""
    if encoding != ZLIB:
        return ""
    if data is None:
        return None
    return zlib.decompress(data).decode("utf-8", errors="replace")


def inflate_or_none(data: bytes | None, encoding: str | None) -> str | None:
    """One payload's text, none if the payload is corrupt."""
    try:
        return inflate_one(data, encoding)
    except zlib.error:
        return None


# Payloads have any size, so they go to Python some at a time: Spark sends 100 rows to
# a plain function at once, and 10,000 in an Arrow batch.
_inflate = F.udf(inflate_one, StringType(), useArrow=False)
_inflate_or_null = F.udf(inflate_or_none, StringType(), useArrow=False)


def is_unread(payload: Column) -> Column:
    """Whether a payload is there but has an encoding that gives no text."""
    return payload.isNotNull() & ~payload["encoding"].eqNullSafe(ZLIB)


def inflate_content(data: Column, encoding: Column, on_error: str = "fail") -> Column:
    """zlib data to text; any other encoding gives empty text.

    A corrupt payload fails the job, or gives null with ``on_error="null"``.
    """
    check_on_error(on_error)
    inflate = _inflate if on_error == "fail" else _inflate_or_null
    return inflate(data, encoding)


def check_on_error(on_error: str) -> None:
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
