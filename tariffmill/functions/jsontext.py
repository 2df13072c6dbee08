"""JSON text of nested columns, in the compact form and in the spaced, ASCII-only form used for hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of whole strings and scalars up to a structural comma or colon; \G keeps matches aligned.
_SEPARATOR = r'\G((?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^",:]++)*+)([,:])'


def json_text(value: Column) -> Column:
    """Compact JSON, nulls kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def spaced(text: Column) -> Column:
    """JSON text with a blank after each comma and colon outside strings."""
    return F.regexp_replace(text, _SEPARATOR, "$1$2 ")


def spaced_json_text(value: Column) -> Column:
    return spaced(json_text(value))


def escape_non_ascii(text: Column) -> Column:
    r"""Write every character beyond ASCII as ``\uXXXX`` (surrogate pairs for the high planes)."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x00-\x7f]+|[^\x00-\x7f]"), F.lit(0))

    def escape(piece: Column) -> Column:
        units = F.lower(F.hex(F.encode(piece, "UTF-16BE")))
        return F.when(
            F.rlike(piece, F.lit(r"^[^\x00-\x7f]")), F.regexp_replace(units, "([0-9a-f]{4})", r"\\u$1")
        ).otherwise(piece)

    return F.when(
        F.rlike(text, F.lit(r"[^\x00-\x7f]")), F.array_join(F.transform(pieces, escape), "")
    ).otherwise(text)


def canonical_json(value: Column) -> Column:
    """The text that is hashed: spaced, ASCII only. Keys come in the order of the struct's fields."""
    return escape_non_ascii(spaced_json_text(value))
