"""Keys and names as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_SEPARATOR = "#"


def joined_key(
    columns: Sequence[str], separator: str = KEY_SEPARATOR, *, escape: bool = True, before: Sequence[str] = ()
) -> Column:
    """Entity values as one string, after the names in `before`. Separators inside parts are
    marked by a backslash, so that different keys never share a string; `escape=False` leaves
    them as they are. Null parts become empty."""
    parts = []
    for part in [*map(F.lit, before), *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns)]:
        if escape:
            part = F.replace(part, F.lit("\\"), F.lit("\\\\"))
            part = F.replace(part, F.lit(separator), F.lit("\\" + separator))
        parts.append(part)
    return F.concat_ws(separator, *parts)


def hashed_name(*parts: str) -> Column:
    """32-bit hash of names joined by `:`, as eight hex digits: the first ones of their MD5."""
    return short_hash(F.lit(":".join(parts)))


def short_hash(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 8)


def schema_ref(schema: T.StructType) -> Column:
    """Short reference of a value schema: a hash of its canonical text."""
    return hashed_name(schema.simpleString())


def trimmed_name(name: str, limit: int = 50) -> str:
    """A storage name of at most `limit` characters; what is cut off is hashed into the
    last eight, so that long names stay different."""
    if len(name) <= limit:
        return name
    import zlib

    head, tail = name[: limit - 8], name[limit - 8 :]
    return f"{head}{zlib.crc32(tail.encode()):08x}"
