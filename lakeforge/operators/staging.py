"""Typed projections of landed entries and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, LongType, MapType, StringType, StructField, StructType, _parse_datatype_string

from lakeforge.sources.sinks import constrained

# Columns of the staging and audit tables as (source, target, kind).
STAGE = (
    ("load_id", "load_id", "string"),
    ("data_source", "data_source", "string"),
    ("eid", "eid", "string"),
    ("dc:title", "title", "string"),
    ("dc:creator", "first_author", "string"),
    ("prism:publicationName", "journal_name", "string"),
    ("prism:issn", "issn", "string"),
    ("prism:eIssn", "eissn", "string"),
    ("prism:volume", "journal_volume", "int"),
    ("prism:issueIdentifier", "journal_issue", "string"),
    ("prism:pageRange", "journal_page_range", "string"),
    ("prism:coverDate", "publication_date", "date"),
    ("prism:doi", "doi", "string"),
    ("dc:description", "abstract", "string"),
    ("citedby-count", "citations", "int"),
    ("affiliation", "affiliations", "json"),
    ("pubmed-id", "pubmed_id", "bigint"),
    ("prism:aggregationType", "publishing_format", "string"),
    ("subtypeDescription", "document_type", "string"),
    ("author-count", "author_count", "json"),
    ("author", "authors", "json"),
    ("publication_keywords", "publication_keywords", "json"),
    ("source-id", "funder_source_id", "string"),
    ("fund-acr", "funder_acronym", "string"),
    ("fund-no", "funder_number", "string"),
    ("fund-sponsor", "funder_name", "string"),
    ("openaccessFlag", "open_access_flag", "boolean"),
    ("open_access_status", "open_access_status", "json"),
)
AUDIT = (
    ("load_id", "load_id", "string"),
    ("data_source", "data_source", "string"),
    ("ingest_timestamp", "ingest_timestamp", "timestamp_ntz"),
    ("query_parameters", "query_parameters", "json"),
    ("ingestion_time", "ingestion_time", "double"),
    ("payload_files", "payload_files", "json"),
    ("payload_results", "payload_results", "json"),
    ("audit_schema_hash_value", "audit_schema_hash_value", "string"),
)
# Columns of the stored staging table (key eid) and of the audit table that keeps reprocessing (key load_id), in order.
STAGE_TABLE = (
    ("load_id", "string"),
    ("scopus_schema_version", "int"),
    ("scopus_schema_hash_value", "string"),
    ("scopus_schema_report", "string"),
    ("checksum_status", "string"),
    ("checksum_timestamp", "timestamp_ntz"),
    ("checksum_report", "string"),
    ("checksum_value", "string"),
    ("data_source", "string"),
    ("eid", "string"),
    ("title", "string"),
    ("first_author", "string"),
    ("journal_name", "string"),
    ("issn", "string"),
    ("eissn", "string"),
    ("journal_volume", "int"),
    ("journal_issue", "string"),
    ("journal_page_range", "string"),
    ("publication_date", "date"),
    ("doi", "string"),
    ("abstract", "string"),
    ("citations", "int"),
    ("affiliations", "string"),
    ("pubmed_id", "bigint"),
    ("publishing_format", "string"),
    ("document_type", "string"),
    ("author_count", "string"),
    ("authors", "string"),
    ("publication_keywords", "string"),
    ("funder_source_id", "string"),
    ("funder_acronym", "string"),
    ("funder_number", "string"),
    ("funder_name", "string"),
    ("open_access_flag", "boolean"),
    ("open_access_status", "string"),
)
AUDIT_TABLE = (
    ("load_id", "string"),
    ("data_source", "string"),
    ("ingest_timestamp", "timestamp_ntz"),
    ("query_parameters", "string"),
    ("audit_schema_version", "int"),
    ("audit_schema_checksum", "string"),
    ("checksum_status", "string"),
    ("checksum_timestamp", "timestamp_ntz"),
    ("checksum_report", "string"),
    ("ingestion_time", "double"),
    ("validation_status", "string"),
    ("validation_errors", "string"),
    ("validation_fails", "string"),
    ("validation_summary", "string"),
    ("dq_report", "string"),
    ("payload_files", "string"),
    ("payload_results", "string"),
    ("is_reprocessed", "boolean"),
    ("original_processing_timestamp", "timestamp_ntz"),
    ("reprocessing_reason", "string"),
)
AUDIT_VERSION = 1
TOLERANT = ("int", "bigint", "date")


def plain(kind: DataType) -> bool:
    """Whether JSON of this type is the same after parsing, but for the order of its keys."""
    if isinstance(kind, StructType):
        return len({f.name.lower() for f in kind}) == len(kind) > 0 and all(plain(f.dataType) for f in kind)
    return plain(kind.elementType) if isinstance(kind, ArrayType) else kind in (StringType(), IntegerType(), LongType(), BooleanType())


def by_key(c: Column, kind: DataType) -> Column:
    """A nested column with the fields of each struct by name, as parsed JSON has them."""
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: by_key(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = sorted(kind, key=lambda f: f.name.encode("utf-16-be"))
        return F.when(c.isNotNull(), F.struct(*(by_key(c[f.name], f.dataType).alias(f.name) for f in fields)))
    return c


def shaped(c: Column, kind: str, given: DataType = StringType()) -> Column:
    """Numbers and dates that do not parse become null; malformed booleans, timestamps and JSON stop the job.

    JSON that is ``given`` as a nested type is written once, not written, parsed and written again.
    """
    if kind == "json":
        if isinstance(given, (ArrayType, MapType, StructType)):
            if plain(given):
                return F.to_json(by_key(c, given))
            c = F.to_json(c)
        return F.to_json(F.parse_json(c))
    return c.try_cast(kind) if kind in TOLERANT else c.cast(kind)


def project(df: DataFrame, columns) -> DataFrame:
    """The listed columns, those that ``df`` lacks as null."""
    there = {f.name: f.dataType for f in df.schema}
    return df.select(*(shaped(F.col(f"`{old}`") if old in there else F.lit(None).cast("string"), kind, there.get(old, StringType())).alias(new) for old, new, kind in columns))


def stage(entries: DataFrame) -> DataFrame:
    """Entries (JSON parts as text or nested) as rows of the staging table, 28 columns."""
    return project(entries, STAGE)


def audit(manifests: DataFrame) -> DataFrame:
    """Manifests (JSON parts as text) as rows of the audit table, 9 columns."""
    return project(manifests, AUDIT).withColumn("audit_schema_version", F.lit(AUDIT_VERSION))


def schema_of(columns, key: str) -> StructType:
    """A table's schema, in which only the key is not nullable."""
    return StructType([StructField(name, _parse_datatype_string(kind), name != key) for name, kind in columns])


def staged_table(staged: DataFrame) -> DataFrame:
    """Staged rows in all 35 columns of the stored table; a null or repeated ``eid`` stops the write."""
    return constrained(staged, schema_of(STAGE_TABLE, "eid"), ["eid"])


def enrich(audits: DataFrame, at: Column) -> DataFrame:
    """Audit rows by name in the 20 columns of the table that keeps reprocessing: first processed ``at``, not reprocessed, no reason.

    A null or repeated ``load_id`` stops the write.
    """
    rows = audits.withColumnRenamed("audit_schema_hash_value", "audit_schema_checksum").withColumn("original_processing_timestamp", at)
    return constrained(rows, schema_of(AUDIT_TABLE, "load_id"), ["load_id"], {"is_reprocessed": False})
