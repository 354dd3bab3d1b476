"""Text forms of binary and nested values, all native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_OPTS = {"ignoreNullFields": "false"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hex_text(c: Column | str) -> Column:
    """Lower-case hex of a binary value (Spark's ``hex`` is upper-case)."""
    return F.lower(F.hex(_c(c)))


def b64_text(c: Column | str) -> Column:
    """Base64 without line breaks, whatever the chunking setting of the session."""
    return F.regexp_replace(F.base64(_c(c)), r"[\r\n]", "")


def json_text(c: Column | str) -> Column:
    """Compact JSON of a struct / array that keeps NULL fields as ``null``."""
    return F.to_json(_c(c), JSON_OPTS)


def canonical_json(c: Column | str) -> Column:
    """Sorted-key compact JSON of a JSON text column (NULL stays NULL).

    Numbers of more than 38 digits, which a variant holds only approximately, keep a document as it is written.
    """
    return F.when(_c(c).cast("string").rlike("[0-9]{39}"), F.trim(_c(c).cast("string"))).otherwise(F.to_json(F.parse_json(_c(c))))


def sha256_b64(c: Column | str) -> Column:
    """base64(sha256(text))."""
    return F.base64(F.unhex(F.sha2(_c(c), 256)))
