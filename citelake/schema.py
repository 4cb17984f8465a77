"""The table contract: column names, types and the fixed names of the record format."""

from pyspark.sql import types as T

# --- fixed values of the public record format -------------------------------
RECORD_TAG = "PubmedArticle"
CITATION_TAG = "MedlineCitation"
DATA_TAG = "PubmedData"
FILE_NUMBER_PATTERN = r"n(\d+)"
XML_SUFFIX = ".xml.gz"
SCHEMA_VERSION = "2.0"
LIST_SEPARATOR = "; "
PART_SEPARATOR = " "
# -----------------------------------------------------------------------------

TABLE_SCHEMA = T.StructType(
    [
        T.StructField("PMID", T.LongType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Abstract", T.StringType()),
        T.StructField("DOI", T.StringType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Authors", T.StringType()),
        T.StructField("Journal", T.StringType()),
        T.StructField("MeSH_Terms", T.StringType()),
        T.StructField("Keywords", T.StringType()),
        T.StructField("Pub_Types", T.StringType()),
        T.StructField("Date_Created", T.StringType()),
        T.StructField("Date_Revised", T.StringType()),
        T.StructField("JSON", T.StringType()),
    ]
)
TABLE_COLUMNS = TABLE_SCHEMA.fieldNames()

# The file a record came from travels with it, so per-file figures need no second parse.
LINEAGE_COLUMN = "src"

# Directory key. It cannot be called "year": Spark resolves names without regard to case, so
# it would shadow the nullable "Year" and turn missing years into 0.
PARTITION_COLUMN = "pub_year"

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)

# Hidden from scans of the table: a leading underscore is passed over.
MANIFEST_FOLDER = "_manifest"
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("accepted", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

DOCUMENT_SCHEMA = T.StructType(
    [T.StructField("PMID", T.StringType()), T.StructField("JSON", T.StringType())]
)
