"""Document URIs: path, components, folders, API paths, language markers."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Fixed pattern: path of a document below its root. Either
# <category>/<type>/<year>/<number>/<lang>, or with an authority after the type
# for authority regulations. No part is empty and the year is digits.
DOCUMENT_PATH = (
    r"^/akn/fi/("
    r"(?:doc/authority-regulation/[^/]+|(?:act|judgment|doc)/[^/]+)"
    r"/\p{Nd}+/[^/]+/[^/]+)\z"
)

# Path of a URL: scheme and host in front, query, fragment and the `;params` of
# the last segment behind. A `;` that a slash follows belongs to the path.
URL_PATH = r"^(?:http[A-Za-z0-9+.\-]*:)?(?://[^/?#]*+)?((?:[^?#;]++|;(?=[^?#]*/))*+)"

# Expressions below refer to their argument as few times as they can: Catalyst
# substitutes them into pushed-down filters, where every further reference
# would repeat the whole parse.


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves `+` and broken escapes as they are.

    The built-in decoder follows form encoding and fails on a broken escape,
    so both are escaped first.
    """
    plus_kept = F.replace(text, F.lit("+"), F.lit("%2B"))
    return F.try_url_decode(F.regexp_replace(plus_kept, "%(?![0-9A-Fa-f]{2})", "%25"))


def normalise_path(uri: Column, base_path: str) -> Column:
    """Decoded path of a URI.

    Text that starts with `http` is taken as a URL: everything around its path
    goes, and so does what stands before the last `base_path`, or that itself.
    Other text is only decoded.
    """
    # URL parsers drop these three characters wherever they stand; they are
    # rare, and looking for them is much cheaper than rewriting every URI.
    blanks = [F.contains(uri, F.lit(blank)) for blank in "\t\r\n"]
    url = F.when(blanks[0] | blanks[1] | blanks[2], F.translate(uri, "\t\r\n", "")).otherwise(uri)
    from_url = F.substring_index(percent_decode(F.regexp_extract(url, URL_PATH, 1)), base_path, -1)
    return F.when(F.startswith(uri, F.lit("http")), from_url).otherwise(percent_decode(uri))


def key_of_path(path: Column) -> Column:
    """Document key of a decoded path: what follows `/akn/fi/`, NULL if it names none."""
    return F.get(F.regexp_extract_all(path, F.lit(DOCUMENT_PATH), F.lit(1)), F.lit(0))


def document_key(uri: Column, base_path: str) -> Column:
    """Document key of a URI, NULL if unmatched."""
    return key_of_path(normalise_path(uri, base_path))


def document_info(key: Column) -> Column:
    """Components of a document key as a struct, NULL for NULL.

    The one-element array binds the split key, so that it is made once for all
    components; a conditional would make it again in each.
    """

    def info(part: Column) -> Column:
        return F.struct(
            F.element_at(part, 1).alias("category"),
            F.element_at(part, 2).alias("document_type"),
            F.when(F.size(part) == 6, F.element_at(part, 3)).alias("authority"),
            F.element_at(part, -3).alias("year"),
            F.element_at(part, -2).alias("number"),
            F.element_at(part, -1).alias("lang_and_version"),
        )

    parts = F.filter(F.array(F.split(key, "/")), lambda part: part.isNotNull())
    return F.get(F.transform(parts, info), F.lit(0))


def parse_uri(uri: Column, base_path: str) -> Column:
    """URI to component struct, NULL if unmatched."""
    return document_info(document_key(uri, base_path))


def key_year(key: Column) -> Column:
    """Year of a document key as INT for range filters; NULL where it does not fit."""
    return F.substring_index(F.substring_index(key, "/", -3), "/", 1).try_cast("int")


def key_number(key: Column) -> Column:
    """Number of a document key, as text."""
    return F.substring_index(F.substring_index(key, "/", -2), "/", 1)


def key_lang(key: Column) -> Column:
    """Language and version marker of a document key."""
    return F.substring_index(key, "/", -1)


def key_folder(key: Column) -> Column:
    """Relative folder of a document key: a `.` part vanishes from a file path."""
    return F.regexp_replace(key, r"/\.(?=/|\z)", "")


def key_api_path(key: Column) -> Column:
    """Request path of a document key."""
    return F.concat(F.lit("/akn/fi/"), key)


def _joined(info: Column) -> Column:
    names = ("category", "document_type", "authority", "year", "number", "lang_and_version")
    parts = [info.getField(name) for name in names]
    # Missing or empty authority is left out.
    parts[2] = F.nullif(parts[2], F.lit(""))
    return F.when(info.isNotNull(), F.concat_ws("/", *parts))


def folder_path(info: Column) -> Column:
    """Relative folder of components, NULL for NULL."""
    return key_folder(_joined(info))


def api_path(info: Column) -> Column:
    """Request path of components, NULL for NULL."""
    return key_api_path(_joined(info))


def lang_version(marker: Column) -> Column:
    """`fin@20230525` to (lang, version, version_date); absent parts are NULL."""
    version = F.nullif(F.substring_index(marker, "@", -1), F.lit(""))
    version = F.when(F.contains(marker, F.lit("@")), version)
    day = F.when(
        F.rlike(version, F.lit(r"^[0-9]{8}\z")),
        F.try_to_timestamp(version, F.lit("yyyyMMdd")).cast("date"),
    )
    return F.struct(
        F.nullif(F.substring_index(marker, "@", 1), F.lit("")).alias("lang"),
        version.alias("version"),
        day.alias("version_date"),
    )


def media_basename(link: Column) -> Column:
    """Last path part of a link; trailing `/` and `/.` do not count."""
    return F.substring_index(F.regexp_replace(link, r"(?:/\.?)+\z", ""), "/", -1)


def request_url(base_url: str, path: Column) -> Column:
    """Base and path joined by exactly one slash."""
    sep = F.when(F.startswith(path, F.lit("/")), F.lit("")).otherwise(F.lit("/"))
    return F.concat(F.lit(base_url), sep, path)


def register_sql_functions(spark: SparkSession, base_path: str) -> None:
    """Make the URI functions callable from SQL in this session.

    They are SQL functions, so Catalyst inlines them as plain expressions:
    `akn_percent_decode`, `akn_path`, `akn_key`, `akn_parse`, `akn_folder`,
    `akn_api_path`.
    """
    base = base_path.replace("\\", "\\\\").replace("'", "\\'")
    info = (
        "STRUCT<category: STRING, document_type: STRING, authority: STRING, "
        "year: STRING, number: STRING, lang_and_version: STRING>"
    )
    joined = (
        "CASE WHEN i IS NOT NULL THEN concat_ws('/', i.category, i.document_type, "
        "nullif(i.authority, ''), i.year, i.number, i.lang_and_version) END"
    )
    bodies = {
        "akn_percent_decode(t STRING) RETURNS STRING": (
            "try_url_decode(regexp_replace(replace(t, '+', '%2B'), '%(?![0-9A-Fa-f]{2})', '%25'))"
        ),
        "akn_path(uri STRING) RETURNS STRING": (
            "CASE WHEN startswith(uri, 'http') THEN substring_index(akn_percent_decode("
            f"regexp_extract(translate(uri, '\t\r\n', ''), r'{URL_PATH}', 1)), '{base}', -1) "
            "ELSE akn_percent_decode(uri) END"
        ),
        "akn_key(uri STRING) RETURNS STRING": (
            f"get(regexp_extract_all(akn_path(uri), r'{DOCUMENT_PATH}', 1), 0)"
        ),
        f"akn_key_info(k STRING, p ARRAY<STRING>) RETURNS {info}": (
            "CASE WHEN k IS NOT NULL THEN named_struct('category', element_at(p, 1), "
            "'document_type', element_at(p, 2), "
            "'authority', CASE WHEN size(p) = 6 THEN element_at(p, 3) END, "
            "'year', element_at(p, -3), 'number', element_at(p, -2), "
            "'lang_and_version', element_at(p, -1)) END"
        ),
        f"akn_of_key(k STRING) RETURNS {info}": "akn_key_info(k, split(k, '/'))",
        f"akn_parse(uri STRING) RETURNS {info}": "akn_of_key(akn_key(uri))",
        f"akn_folder(i {info}) RETURNS STRING": (
            rf"regexp_replace({joined}, r'/\.(?=/|\z)', '')"
        ),
        f"akn_api_path(i {info}) RETURNS STRING": f"'/akn/fi/' || {joined}",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
