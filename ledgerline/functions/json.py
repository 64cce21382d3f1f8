"""JSON document functions (FN15-FN18, JS4, JS5, JS10).

``JSON_VALUE`` returns scalars only and ``JSON_QUERY`` objects/arrays only.
Both are answered from a single variant parse of the document so the two
cases are told apart by the JSON type, not by sniffing the text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


_QUOTED = re.compile(r'\."((?:[^"\\]|\\.)*)"')


def normalize_path(path: str) -> str:
    """Rewrite T-SQL quoted members ``$."a b"`` as ``$['a b']``."""
    return _QUOTED.sub(lambda m: "['" + m.group(1).replace("'", "\\'") + "']", path)


def _variant_at(doc: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(doc), normalize_path(path), "variant")


def json_value(doc, path: str) -> Column:
    """T-SQL ``JSON_VALUE(doc, path)`` (lax): scalar text, NULL for objects/arrays."""
    v = _variant_at(_c(doc), path)
    kind = F.schema_of_variant(v)
    return F.when(~kind.rlike("^(OBJECT|ARRAY)"), F.try_variant_get(v, "$", "string"))


def json_query(doc, path: str) -> Column:
    """T-SQL ``JSON_QUERY(doc, path)``: object/array text, NULL for scalars (FN16)."""
    v = _variant_at(_c(doc), path)
    kind = F.schema_of_variant(v)
    return F.when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(v))


def json_path_text(doc, path: str) -> Column:
    """``get_json_object`` with quoted-member paths accepted (fast path)."""
    return F.get_json_object(_c(doc), normalize_path(path))


def count_events(doc, event: str, array_path: str = "$.Events", field: str = "Event") -> Column:
    """Number of elements of the array at ``array_path`` whose ``field`` equals ``event``."""
    schema = ArrayType(StructType([StructField(field, StringType())]))
    arr = F.from_json(F.get_json_object(_c(doc), normalize_path(array_path)), schema)
    return F.size(F.filter(arr, lambda e: e[field] == F.lit(event)))


def has_repeated_event(doc, event: str, array_path: str = "$.Events", field: str = "Event") -> Column:
    """JS5: more than one ``event`` element in the document's event array.

    Parses the array instead of ``LIKE '%X%X%'`` on its text, which would
    also match the word inside other fields.
    """
    return count_events(doc, event, array_path, field) > 1


def like_repeated(doc, event: str, array_path: str = "$.Events") -> Column:
    """The literal ``JSON_QUERY(doc, path) LIKE '%X%X%'`` form, kept as an alternate."""
    return json_query(doc, array_path).like(f"%{event}%{event}%")


def build_json(*cols, **named) -> Column:
    """JS10: JSON text from columns, with correct escaping (not string concatenation)."""
    parts = list(cols) + [_c(v).alias(k) for k, v in named.items()]
    return F.to_json(F.struct(*parts))


def explode_rows(df, array_col, alias: str, *keep):
    """``explode`` without the inferred pre-filter.

    For an inner ``explode`` Catalyst infers ``size(arr) > 0 AND arr IS NOT
    NULL`` and pushes it below the projection that computes ``arr``; when
    ``arr`` comes from ``from_json`` the document is then parsed three times
    per row.  ``explode_outer`` has no such filter, and dropping the NULL
    element afterwards gives the same rows as ``explode``.
    """
    return df.select(*keep, F.explode_outer(_c(array_col)).alias(alias)).where(F.col(alias).isNotNull())
