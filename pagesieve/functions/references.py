"""Character references of HTML as a lookup structure for column expressions.

The table of names is the standard library's. It becomes one literal: names are dealt
to BUCKETS by checksum, a bucket is a text of ``name value`` entries, so a reference
costs a checksum and a search in a few entries, however long the table is.
"""

from __future__ import annotations

import html.entities
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 512
_ENTRY, _VALUE, _BUCKET = "\x01", "\x02", "\x03"

# A reference after its '&': numeric or a name, the semicolon may be missing.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that count without their semicolon, the longest that fits first.
_OPEN = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
OPEN_NAME = f"^({'|'.join(_OPEN)})"


def _table() -> str:
    buckets = [""] * BUCKETS
    for name, value in sorted(html.entities.html5.items()):
        buckets[zlib.crc32(name.encode()) % BUCKETS] += f"{_ENTRY}{name}{_VALUE}{value}"
    return _BUCKET.join(buckets)


_TABLE = _table()


def named(name: Column) -> Column:
    """What a name (with its semicolon, if it has one) stands for; null for no such name."""
    bucket = F.get(F.split(F.lit(_TABLE), _BUCKET), F.pmod(F.crc32(name), F.lit(BUCKETS)).cast("int"))
    key = F.concat(F.lit(_ENTRY), name, F.lit(_VALUE))
    value = F.substring_index(F.call_function("substring_index", bucket, key, F.lit(-1)), _ENTRY, 1)
    return F.when(F.contains(bucket, key), value)
