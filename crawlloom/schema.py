"""Row types and the fixed rule tables shared by the operators."""

from pyspark.sql import types as T

WARC_RECORD = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("warc_type", T.StringType()),
        T.StructField("rec_content_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("warc_filename", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("http_ok", T.BooleanType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("http_headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body", T.BinaryType()),
    ]
)

TEXT_COLUMNS = ["source", "date", "record_id", "uri", "content_type", "lang", "text"]
TEXT_RECORD = T.StructType([T.StructField(c, T.StringType()) for c in TEXT_COLUMNS])

# MIME types whose bodies are text.
TEXT_TYPES = [
    "text/plain",
    "text/html",
    "text/vnd.wap.wml",
    "application/xml",
    "application/atom+xml",
    "application/opensearchdescription+xml",
    "application/rss+xml",
    "application/xhtml+xml",
]

# Misspelt content types and what they stand for.
CONTENT_TYPE_FIXES = {
    "txt": "text/plain",
    "text": "text/plain",
    "text/plan": "text/plain",
}

# Zip-based document types, the URI endings that imply them, and
# the archive members that hold their text.
ZIP_RULES = [
    # (type, URI endings, member name pattern)
    ("application/vnd.oasis.opendocument.text", ["odt"], r"^content\.xml$"),
    ("application/vnd.oasis.opendocument.spreadsheet", ["ods"], r"^content\.xml$"),
    ("application/vnd.oasis.opendocument.presentation", ["odp"], r"^content\.xml$"),
    (
        "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
        ["docx"],
        r"^word/document\.xml$",
    ),
    (
        "application/vnd.openxmlformats-officedocument.presentationml.presentation",
        ["pptx"],
        r"^ppt/slides/slide.*$",
    ),
    (
        "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
        # the first spelling is a widespread typo that is honoured as well
        ["xslx", "xlsx"],
        r"^xl/sharedStrings\.xml$",
    ),
    ("application/epub+zip", ["epub"], r"^.*ml$"),
]

# Header names of one member of a record archive, in file order.
ARCHIVE_HEADERS = [
    # (header name, text record column)
    ("Content-Location", "uri"),
    ("Content-Type", "content_type"),
    ("Content-Language", "lang"),
    ("Content-Length", None),
    ("Date", "date"),
    ("X-WARC-Record-ID", "record_id"),
    ("X-WARC-Filename", "source"),
]
