"""JSON path extraction with ``JSON_VALUE`` semantics.

``get_json_object`` returns the text of objects and arrays; ``JSON_VALUE``
returns NULL for them. Parsing to VARIANT lets us tell the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parsed(col) -> Column:
    """The document as VARIANT (NULL for bad JSON): parse once, then read many paths."""
    return F.try_parse_json(_c(col))


def variant_scalar(doc: Column, path: str) -> Column:
    """Scalar at ``path`` of a parsed document as text; NULL for missing keys, objects, arrays."""
    node = F.try_variant_get(doc, path, "variant")
    kind = F.schema_of_variant(node)
    is_container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(node.isNull() | is_container, F.lit(None).cast("string")) \
        .otherwise(F.try_variant_get(node, "$", "string"))


def variant_query(doc: Column, path: str) -> Column:
    """JSON text of the node at ``path`` of a parsed document; NULL for a missing path."""
    node = F.try_variant_get(doc, path, "variant")
    return F.when(node.isNotNull(), F.to_json(node))


def json_scalar(col, path: str) -> Column:
    """Scalar at ``path`` as text; NULL for missing keys, objects, arrays, bad JSON."""
    return variant_scalar(parsed(col), path)


def json_bool(col, path: str, strict: bool = True) -> Column:
    """``CAST(JSON_VALUE(x, path) AS BOOL)``: only 'true'/'false' (any case) convert.

    Other text raises, as in the warehouse; with ``strict=False`` it is NULL.
    (Spark's own boolean cast would also accept 'yes', '1' and 't'.)
    """
    text = F.lower(F.trim(json_scalar(col, path)))
    other = F.raise_error(F.concat(F.lit("not a boolean: "), text)).cast("boolean") if strict \
        else F.lit(None).cast("boolean")
    return F.when(text.isNull(), F.lit(None).cast("boolean")).when(text == "true", F.lit(True)) \
        .when(text == "false", F.lit(False)).otherwise(other)


def json_query(col, path: str) -> Column:
    """``JSON_QUERY``: the JSON text of the node at ``path`` (object, array or
    JSON-encoded scalar); NULL for a missing path or bad JSON."""
    return variant_query(parsed(col), path)
