"""Media links and bibliographic metadata of Akoma Ntoso documents."""

from __future__ import annotations

from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# The document namespace and the prefix of media links.
AKN_NAMESPACE = "http://docs.oasis-open.org/legaldocml/ns/akn/3.0"
MEDIA_PREFIX = "media/"


# Bytes handed to the parser at a time.
PARSE_BYTES = 1 << 20
_IMAGE, _ATTACHMENT, _REFERENCE = (f"{AKN_NAMESPACE} {name}" for name in ("img", "attachment", "ref"))


def document_links(document: memoryview, encoding: str | None = "utf-8") -> list[str]:
    """Distinct links of one document in order; none if it is not well-formed.

    The parser reads the document piece by piece and keeps no tree: memory is that of the
    links. `encoding` None takes the one that the document declares.
    """
    parser = expat.ParserCreate(encoding, namespace_separator=" ")
    found: set[str] = set()
    attachments = 0  # open ones; everything within has links

    def start(name: str, attributes: dict[str, str]) -> None:
        nonlocal attachments
        if attachments or name == _ATTACHMENT:
            attachments += name == _ATTACHMENT
            link = attributes.get("href")
        elif name == _REFERENCE:
            link = attributes.get("href")
        else:
            link = None
        if link is not None:
            found.add(link)
        if name == _IMAGE and (link := attributes.get("src")) is not None:
            found.add(link)

    def end(name: str) -> None:
        nonlocal attachments
        attachments -= name == _ATTACHMENT

    def skipped(name: str, is_parameter: bool) -> None:
        if not is_parameter:
            raise ValueError(f"undefined entity {name}")

    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.SkippedEntityHandler = skipped
    try:
        for at in range(0, len(document), PARSE_BYTES):
            parser.Parse(document[at : at + PARSE_BYTES], False)
        parser.Parse(b"", True)
    except (expat.ExpatError, ValueError, LookupError):
        return []
    return sorted(found)


def _link_array(documents: pa.Array) -> pa.Array:
    """Links of an Arrow column, read from its buffer without copies."""
    kind = documents.type
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    encoding = None if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else "utf-8"
    _, offsets, data = documents.buffers()
    bounds = memoryview(offsets).cast("q" if wide else "i") if offsets is not None else []
    view = memoryview(data) if data is not None else memoryview(b"")
    lists = [
        document_links(view[bounds[at] : bounds[at + 1]], encoding) if valid else []
        for at, valid in enumerate(documents.is_valid().to_pylist(), documents.offset)
    ]
    return pa.array(lists, pa.list_(pa.string()))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _link_lists(documents: pa.Array) -> pa.Array:
    return _link_array(documents)


def links(xml: Column) -> Column:
    """All distinct link targets of image, attachment and reference elements.

    The built-in XPath functions do not know namespaces and fail on malformed
    input, hence the Arrow batch function. NULL gives an empty list. Takes
    text, or binary for documents that declare another encoding.
    """
    return _link_lists(xml)


def may_hold_media(xml: Column) -> Column:
    """FALSE only where a text cannot hold a media link.

    A link that starts with the prefix has it literally, unless some of its
    characters are written as character references or come from an entity.
    """
    return (
        F.contains(xml, F.lit(MEDIA_PREFIX))
        | F.contains(xml, F.lit("&#"))
        | F.contains(xml, F.lit("<!ENTITY"))
    )


def filter_media_links(link_list: Column) -> Column:
    """Links below `media/`."""
    return F.filter(link_list, lambda link: F.startswith(link, F.lit(MEDIA_PREFIX)))


def media_links(xml: Column, *, is_text: bool = True) -> Column:
    """Distinct media links in order; empty for malformed documents.

    Text that cannot hold a link is not sent to the Python workers at all.
    """
    sent = F.when(may_hold_media(xml), xml) if is_text else xml
    return filter_media_links(links(sent))


_FRBR_DATE = "FRBRdate ARRAY<STRUCT<_date: STRING, _name: STRING>>"
_FRBR_IDS = (
    "FRBRthis STRUCT<_value: STRING>, FRBRuri STRUCT<_value: STRING>, "
    "FRBRalias ARRAY<STRUCT<_name: STRING, _value: STRING>>"
)
_META = (
    "meta STRUCT<identification: STRUCT<"
    f"FRBRWork: STRUCT<{_FRBR_IDS}, {_FRBR_DATE}, FRBRsubtype STRUCT<_value: STRING>, "
    "FRBRnumber STRUCT<_value: STRING>>, "
    f"FRBRExpression: STRUCT<{_FRBR_IDS}, FRBRlanguage STRUCT<_language: STRING>>, "
    f"FRBRManifestation: STRUCT<{_FRBR_IDS}>>, "
    "proprietary: STRUCT<documentYear: STRING>>"
)
_DOCUMENT = (
    f"act STRUCT<{_META}>, judgment STRUCT<{_META}>, doc STRUCT<{_META}>, _corrupt_record STRING"
)


def parsed_document(xml: Column) -> Column:
    """The metadata block of a document, by one pass of the XML reader."""
    return F.from_xml(xml, F.lit(_DOCUMENT), {"mode": "PERMISSIVE", "ignoreNamespace": "true"})


def frbr_fields(document: Column) -> dict[str, Column]:
    """Metadata columns by name from `parsed_document`; NULL where absent."""
    meta = F.coalesce(*[document.getField(kind).getField("meta") for kind in ("act", "judgment", "doc")])
    identification = meta.getField("identification")

    def named(entries: Column, name: str, field: str) -> Column:
        hits = F.filter(entries, lambda entry: entry.getField("_name") == name)
        return F.get(hits, F.lit(0)).getField(field)

    columns: dict[str, Column] = {}
    for level, block in (
        ("work", "FRBRWork"),
        ("expression", "FRBRExpression"),
        ("manifestation", "FRBRManifestation"),
    ):
        node = identification.getField(block)
        columns[f"{level}_this"] = node.getField("FRBRthis").getField("_value")
        columns[f"{level}_uri"] = node.getField("FRBRuri").getField("_value")
        columns[f"{level}_eli"] = named(node.getField("FRBRalias"), "eli", "_value")
    work = identification.getField("FRBRWork")
    for column, name in (("date_issued", "dateIssued"), ("date_published", "datePublished")):
        columns[column] = named(work.getField("FRBRdate"), name, "_date").try_cast("date")
    columns["subtype"] = work.getField("FRBRsubtype").getField("_value")
    columns["number"] = work.getField("FRBRnumber").getField("_value")
    columns["language"] = (
        identification.getField("FRBRExpression").getField("FRBRlanguage").getField("_language")
    )
    columns["document_year"] = meta.getField("proprietary").getField("documentYear").try_cast("int")
    return columns
