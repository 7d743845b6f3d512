"""Column builders: nested JSON shaping, strings, hashes, ids, versions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, _parse_datatype_string

# Texts that stand for a missing value, renames of payload keys, page numbers in file names, words in data types.
MISSING = ("None", "null", "undefined", "", "[]", "{}")
RENAMES = {
    "afid": "scopus_affiliation_id",
    "affilname": "scopus_affiliation_name",
    "affiliation-city": "scopus_affiliation_city",
    "affiliation-country": "scopus_affiliation_country",
    "affiliation-url": "scopus_affiliation_url",
    "@seq": "author_list_position",
    "author-url": "scopus_author_page_url",
    "authid": "scopus_author_id",
    "authkeywords": "publication_keywords",
    "freetoreadLabel": "open_access_status",
}
PAGE_PATTERNS = (r"page(\d+)", r"page_(\d+)", r"p(\d+)", r"_(\d+)\.json", r"_(\d+)_")
COUNT_RENAMES = {"@limit": "scopus_exported_authors_limit", "@total": "scopus_total_authors_count", "$": "scopus_exported_authors_count"}
TYPE_WORDS = (
    ("string", "VARCHAR|TEXT|CHAR|STRING"),
    ("integer", "INTEGER|INT|BIGINT|SMALLINT"),
    ("numeric", "DECIMAL|NUMERIC|FLOAT|DOUBLE|REAL"),
    ("boolean", "BOOLEAN|BOOL"),
    ("datetime", "DATE|TIME|TIMESTAMP"),
    ("json", "JSON"),
)


def strip(c: Column) -> Column:
    """Without white space at both ends (all of it, not blanks alone)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_json(drop: Sequence[str] = (), rename: Mapping[str, str] = {}):
    """Arrow UDF over JSON text: drops and renames keys at every depth; what does not parse stays as it is."""
    gone, names = frozenset(drop), dict(rename)

    def walk(x):
        if isinstance(x, dict):
            return {names.get(k, k): walk(v) for k, v in x.items() if k not in gone}
        return [walk(v) for v in x] if isinstance(x, list) else x

    def one(s):
        try:
            return json.dumps(walk(json.loads(s)), ensure_ascii=False)
        except (TypeError, ValueError):
            return s

    @F.pandas_udf("string")
    def clean(s: pd.Series) -> pd.Series:
        return s.map(one, na_action="ignore")

    return clean


def json_shape(df: DataFrame, column: str) -> DataType | None:
    """The shape that all JSON texts of a column share, from one pass; None where there is none (values of different kinds in one place)."""
    text = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    if text is None or "VARIANT" in text:
        return None
    return _parse_datatype_string(text.replace("OBJECT<>", "MAP<STRING, STRING>").replace("OBJECT<", "STRUCT<").replace(": VOID", ": STRING").replace("<VOID>", "<STRING>"))


def _reshaped(x: Column, kind: DataType, drop: frozenset, rename: Mapping[str, str]) -> Column:
    if isinstance(kind, ArrayType):
        return F.transform(x, lambda y: _reshaped(y, kind.elementType, drop, rename))
    if not isinstance(kind, StructType):
        return x
    fields = [_reshaped(x.getField(f.name), f.dataType, drop, rename).alias(rename.get(f.name, f.name)) for f in kind if f.name not in drop]
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.when(x.isNotNull(), F.struct(*fields) if fields else none)


def clean_json_column(df: DataFrame, column: str, drop: Sequence[str] = (), rename: Mapping[str, str] = {}) -> Column:
    """:func:`clean_json` in built-in functions, for texts that share a shape; the function itself where they do not.

    Members that are null go, members come in the order of their old names, without blanks between them. What does not
    parse stays as it is.
    """
    kind = json_shape(df, column)
    names = lambda k: [[rename.get(f.name, f.name) for f in k if f.name not in drop], *(x for f in k for x in names(f.dataType))] if isinstance(k, StructType) else names(k.elementType) if isinstance(k, ArrayType) else []
    if not isinstance(kind, (StructType, ArrayType)) or any(len(set(n)) < len(n) for n in names(kind)):
        return clean_json(drop, rename)(column)
    parsed = _reshaped(F.from_json(F.col(column), kind), kind, frozenset(drop), rename)
    return F.when(F.try_parse_json(column).isNull(), F.col(column)).otherwise(F.to_json(parsed))


def rename_fields(struct: Column, names: Mapping[str, str]) -> Column:
    """A struct's listed fields under new names."""
    return F.struct(*(struct[old].alias(new) for old, new in names.items()))


def unwrap_dollar(items: Column) -> Column:
    """Of an array of variants each ``{"$": v}`` as v, other items unchanged."""
    return F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, '$["$"]', "variant"), x))


def unwrap_value(v: Column) -> Column:
    """JSON text of a variant: ``{"value": [...]}`` as its unwrapped items, anything else unchanged."""
    return F.coalesce(F.to_json(unwrap_dollar(F.try_variant_get(v, "$.value", "array<variant>"))), F.to_json(v))


def drop_listed(s: Column, keys: Column) -> Column:
    """A JSON object without the top-level keys in the array ``keys``; unchanged where there is no list or no object."""
    kept = F.map_filter(F.from_json(s, "map<string,variant>"), lambda k, _: ~F.array_contains(keys, k))
    return F.coalesce(F.when(keys.isNotNull(), F.to_json(kept)), s)


def json_path_int(v: Column, path: str) -> Column:
    """The integer at a dotted path of a variant (keys may hold colons and hyphens); null when missing or no number."""
    return F.try_variant_get(v, "$" + "".join(f'["{k}"]' for k in path.split(".")), "int")


def split_keywords(s: Column) -> Column:
    """Parts between bars, stripped; null when nothing is left."""
    parts = F.filter(F.transform(F.split(F.when(strip(s) != "undefined", s), "[|]"), strip), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts)


def author_name(given: Column, surname: Column) -> Column:
    return F.trim(F.concat(F.coalesce(given, F.lit("")), F.lit(" "), F.coalesce(surname, F.lit(""))))


def mapped_json(s: Column, schema: str, fn) -> Column:
    """A JSON array with ``fn`` applied to each element; what does not parse stays as it is."""
    return F.coalesce(F.to_json(F.transform(F.from_json(s, schema), fn)), s)


def null_normalise(df: DataFrame, keep: Sequence[str] = ("load_id", "data_source", "eid")) -> DataFrame:
    """Values that stand for nothing become null, in one projection over all columns."""
    return df.select(*(F.col(c) if c in keep else F.when(~F.trim(F.col(c).cast("string")).isin(*MISSING), F.col(c)).alias(c) for c in df.columns))


def nested_as_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed nested columns as JSON text; nulls stay null."""
    return df.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in columns})


def json_items(s: Column) -> Column:
    """How many items a JSON array has; null for any other text."""
    return F.json_array_length(s)


def append_distinct(items: Column, value: Column) -> Column:
    """The array with ``value`` at its end if it lacks it; a null array counts as empty, a null value adds nothing."""
    some = F.coalesce(items, F.array_compact(F.array(F.when(F.lit(False), value))))
    return F.array_union(some, F.array_compact(F.array(value)))


def safe_name(c: Column, unsafe: str = "/", by: str = "_") -> Column:
    """A name with each of the signs ``unsafe`` replaced."""
    return F.translate(c, unsafe, by * len(unsafe))


def query_parameters(manifest: Column) -> Column:
    """JSON array of a manifest's parameters: ``all_query_parameters``, else the one of ``query_parameters``, else none."""
    m = F.try_parse_json(manifest)
    every, one = F.try_variant_get(m, "$.all_query_parameters", "array<variant>"), F.try_variant_get(m, "$.query_parameters", "variant")
    return F.coalesce(F.to_json(F.coalesce(every, F.when(one.isNotNull(), F.array(one)))), F.lit("[]"))


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(""))


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.when(F.startswith(c, F.lit(prefix)), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def page_from_filename(name: Column) -> Column:
    """Page number by the first pattern that fits, else null."""
    return F.coalesce(*(F.nullif(F.regexp_extract(F.lower(name), p, 1), F.lit("")) for p in PAGE_PATTERNS)).try_cast("int")


def load_id(source: Column, ts: Column, seed: Column) -> Column:
    return F.concat_ws("_", source, F.date_format(ts, "yyyyMMdd_HHmmss"), F.substr(F.md5(seed), F.lit(1), F.lit(8)))


def load_id_parts(c: Column) -> tuple[Column, Column]:
    """Source and timestamp of a load id; null when malformed."""
    p = r"^(.+)_(\d{8})_?(\d{6})(_[0-9a-f]{8})?$"
    return F.nullif(F.regexp_extract(c, p, 1), F.lit("")), F.try_to_timestamp(F.nullif(F.concat(F.regexp_extract(c, p, 2), F.regexp_extract(c, p, 3)), F.lit("")), F.lit("yyyyMMddHHmmss"))


def content_hash(s: Column) -> Column:
    """Equal for JSON texts that differ in key order or spacing only."""
    return F.md5(F.to_json(F.try_parse_json(s)).cast("binary"))


def hash_equal(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def request_fingerprint(url: Column, method: Column, params: Column, headers: Column) -> Column:
    """One hash for requests that differ in the order of parameters or headers alone."""
    ordered = lambda m: F.coalesce(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m)))), F.lit("{}"))
    return F.md5(F.concat_ws("|", method, url, ordered(params), ordered(headers)).cast("binary"))


def type_category(c: Column) -> Column:
    out = F.lit("other")
    for name, words in reversed(TYPE_WORDS):
        out = F.when(F.upper(c).rlike(words), name).otherwise(out)
    return out


def varchar_length(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.upper(c), r"VARCHAR\((\d+)\)", 1), F.lit("")).try_cast("int")


def semver_bump(version: Column, level: Column) -> Column:
    """breaking: major, warning: minor, safe: patch; 1.0.0 when there is none or it is malformed."""
    part = [F.element_at(F.split(version, r"\."), i).cast("int") for i in (1, 2, 3)]
    bumped = F.when(level == "breaking", F.concat_ws(".", (part[0] + 1).cast("string"), F.lit("0"), F.lit("0"))).when(level == "warning", F.concat_ws(".", part[0].cast("string"), (part[1] + 1).cast("string"), F.lit("0"))).otherwise(F.concat_ws(".", part[0].cast("string"), part[1].cast("string"), (part[2] + 1).cast("string")))
    return F.when(version.rlike(r"^\d+\.\d+\.\d+$"), bumped).otherwise("1.0.0")


def duration_seconds(start: Column, end: Column) -> Column:
    return F.coalesce(F.round((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6, 2), F.lit(0.0))


def map_upsert(m: Column, key: Column, value: Column) -> Column:
    return F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(key, value))


def stable_bits(s: Column) -> Column:
    """48 bits of md5 as a long."""
    return F.conv(F.substr(F.md5(s.cast("binary")), F.lit(1), F.lit(12)), 16, 10).cast("long")
