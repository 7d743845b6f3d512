"""Boolean columns: validity of values, responses, errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payload keys, the usual place of the announced total, and names of errors that stop a run.
STRUCTURE_KEYS = ("search-results", "results", "data", "response", "entries")
TOTAL_PATH = '$["search-results"]["opensearch:totalResults"]'
STOPPING = ("RateLimitError", "AuthenticationError", "PermanentAPIError", "ConfigurationError")


def valid_length(c: Column, low: int | None = None, high: int | None = None) -> Column:
    n = F.length(c.cast("string"))
    return (n >= low if low is not None else F.lit(True)) & (n <= high if high is not None else F.lit(True))


def valid_regex(c: Column, pattern: str) -> Column:
    """Whether the whole value matches; null for null."""
    return c.rlike(f"^(?:{pattern})$")


def valid_values(c: Column, values: Sequence) -> Column:
    """Whether the value is one of those listed; null for null."""
    return c.isin(*values)


def total_of(v: Column, path: str = TOTAL_PATH) -> Column:
    """The announced total of a parsed response; ``path`` is configured by source."""
    return F.try_variant_get(v, path, "long")


def has(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind).isNotNull()


def length_of(v: Column, path: str) -> Column:
    """Items of an array; 0 for what is none."""
    return F.coalesce(F.size(F.try_variant_get(v, path, "array<variant>")), F.lit(0))


def items_of(v: Column) -> Column:
    """How many items a parsed response holds, in the first place that is there."""
    results = F.when(has(v, "$.results.data"), length_of(v, "$.results.data")).otherwise(length_of(v, "$.results.items"))
    return F.when(has(v, '$["search-results"]'), length_of(v, '$["search-results"].entry')).when(has(v, "$.results", "map<string,variant>"), results).when(has(v, "$.data"), length_of(v, "$.data")).otherwise(length_of(v, "$.items"))


def response_complete(s: Column, path: str = TOTAL_PATH) -> Column:
    v = F.try_parse_json(s)
    return F.coalesce(total_of(v, path) == items_of(v), F.lit(False))


def response_empty(s: Column) -> Column:
    """Unparseable or no object, an empty one, or a result part that announces no items or holds none."""
    v = F.try_parse_json(s)
    search = has(v, '$["search-results"]') & ((F.coalesce(total_of(v), F.lit(0)) == 0) | (length_of(v, '$["search-results"].entry') == 0))
    count = F.coalesce(F.try_variant_get(v, "$.results.totalCount", "long"), F.try_variant_get(v, "$.results.count", "long"), F.lit(0))
    items = F.when(has(v, "$.results.data"), length_of(v, "$.results.data")).otherwise(length_of(v, "$.results.items"))
    results = has(v, "$.results", "map<string,variant>") & ((count == 0) | (items == 0))
    return v.isNull() | F.coalesce(F.size(F.json_object_keys(s)) == 0, F.lit(True)) | search | results


def response_structure(s: Column, keys: Sequence[str] = STRUCTURE_KEYS) -> Column:
    return F.coalesce(F.exists(F.json_object_keys(s), lambda k: k.isin(*keys)), F.lit(False))


def header_present(headers: Column, required: str | None) -> Column:
    return F.lit(True) if required is None else F.coalesce(F.map_contains_key(headers, required), F.lit(False))


def response_valid(s: Column, complete: Column, not_empty: Column, structure: Column, path: str = TOTAL_PATH, headers: Column | None = None, required: str | None = None) -> Column:
    """All checks that are enabled (boolean columns, null: off) pass; with ``headers``, the ``required`` one must be among them."""
    on = lambda flag, ok: ~F.coalesce(flag, F.lit(False)) | ok
    header = F.lit(True) if headers is None else header_present(headers, required)
    return on(complete, response_complete(s, path)) & on(not_empty, ~response_empty(s)) & on(structure, response_structure(s)) & header


def error_is_critical(message: Column, kind: Column) -> Column:
    m = F.lower(F.coalesce(message, F.lit("")))
    return m.like("%rate limit%") | m.like("%auth%") | m.like("%401%") | F.coalesce(kind.isin(*STOPPING), F.lit(False))


def envelope(s: Column, result: str = '["search-results"]') -> Column:
    """A payload file has its metadata, a raw response, and the result part in it."""
    v = F.try_parse_json(s)
    return F.coalesce(has(v, "$.metadata") & has(v, "$.raw_response" + result), F.lit(False))
