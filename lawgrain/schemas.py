"""Record types of the landing zone and the catalogue."""

from __future__ import annotations

from pyspark.sql import types as T

_STR = T.StringType()
_LONG = T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# One element of a list page.
LIST_ITEM = _struct(("akn_uri", _STR), ("status", _STR))

# One list page as it was answered; `body` is the raw JSON text.
LIST_PAGE = _struct(
    ("category", _STR),
    ("document_type", _STR),
    ("page", _LONG),
    ("http_status", T.IntegerType()),
    ("body", _STR),
)

# Components of a document URI. Year and number stay text, as in the URI.
DOCUMENT_INFO = _struct(
    ("category", _STR),
    ("document_type", _STR),
    ("authority", _STR),
    ("year", _STR),
    ("number", _STR),
    ("lang_and_version", _STR),
)

# One entry of the manifest. Times are local and without a zone.
MANIFEST_ENTRY = _struct(
    ("akn_uri", _STR),
    ("status", _STR),
    ("timestamp", T.TimestampNTZType()),
    ("files", T.ArrayType(_STR)),
    ("error", _STR),
)

# Counts of a run's entries.
SUMMARY = _struct(("total", _LONG), ("success", _LONG), ("skipped", _LONG), ("error", _LONG))

# Nested manifest file, as written by single-machine harvesters.
MANIFEST_FILE = _struct(
    ("updated_at", T.TimestampNTZType()),
    ("total_entries", _LONG),
    ("success_count", _LONG),
    ("skipped_count", _LONG),
    ("error_count", _LONG),
    ("entries", T.ArrayType(MANIFEST_ENTRY)),
)

# State file, as written by single-machine harvesters.
STATE_FILE = _struct(
    ("current_category", _STR),
    ("current_document_type", _STR),
    ("current_page", _LONG),
    ("last_uri", _STR),
    ("completed_uris", T.ArrayType(_STR)),
    ("started_at", T.TimestampNTZType()),
    ("updated_at", T.TimestampNTZType()),
)

COMPLETED = _struct(("akn_uri", _STR))

PROGRESS = _struct(
    ("category", _STR),
    ("document_type", _STR),
    ("position", _LONG),
    ("updated_at", T.TimestampNTZType()),
)

# A stored document; category, type and year are its partition.
CORPUS = _struct(("akn_uri", _STR), ("info", DOCUMENT_INFO), ("xml", _STR))

# One row per HTTP attempt; `run_id` names the run that made it and sorts by time. `link` names the media file, else NULL; a failed
# connection has an `exception` and no status.
ATTEMPT = _struct(
    ("run_id", _STR),
    ("akn_uri", _STR),
    ("kind", _STR),
    ("link", _STR),
    ("attempt", _LONG),
    ("http_status", T.IntegerType()),
    ("exception", _STR),
    ("start_ts", T.TimestampNTZType()),
    ("end_ts", T.TimestampNTZType()),
)

# Statuses a manifest entry may hold.
MANIFEST_STATUSES = ("success", "skipped", "error", "dry-run")
