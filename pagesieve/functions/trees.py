"""Arrow helper for JSON searched in document order.

VARIANT values sort their keys, so the first list of objects in document order is
outside Spark's built-in functions when it is not in one of the usual places. The
helper gets Arrow batches and sees null for rows that do not need it.
"""

from __future__ import annotations

import json
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed

# Ship the helper with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TEXTS = T.ArrayType(T.StringType())
_CONTAINERS = list(fixed.JSON_CONTAINERS)


def first_objects(text: str) -> list[str] | None:
    """Records of a payload as JSON texts; null when the text is no JSON."""
    try:
        waiting = [json.loads(text)]
    except (ValueError, RecursionError):
        return None
    while waiting:
        node = waiting.pop()
        if isinstance(node, list):
            found = [json.dumps(x, ensure_ascii=False) for x in node if isinstance(x, dict)]
            if found:
                return found
        elif isinstance(node, dict):
            keys = [k for k in _CONTAINERS if k in node]
            keys += [k for k in node if k not in _CONTAINERS]
            waiting.extend(node[k] for k in reversed(keys))
    return []


@F.arrow_udf(_TEXTS)
def json_first_objects(body: pa.Array) -> pa.Array:
    return pa.array((None if v is None else first_objects(v) for v in body.to_pylist()), type=pa.list_(pa.string()))
