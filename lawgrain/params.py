"""Job parameters: what the command line of a harvester would carry."""

from __future__ import annotations

from dataclasses import dataclass, field

# Document types of each category, in request order.
DOCUMENT_TYPES: dict[str, list[str]] = {
    "act": [
        "statute",
        "statute-consolidated",
        "statute-translated",
        "statute-aland",
        "statute-sami",
    ],
    "judgment": ["kko", "kho"],
    "doc": [
        "government-proposal",
        "treaty",
        "treaty-consolidated",
        "authority-regulation",
    ],
}

# Fixed value: a document type that may also be requested like a category.
AUTHORITY_TYPE = "authority-regulation"

# HTTP statuses that are retried, and how often.
RETRY_STATUSES = (429, 500, 502, 503, 504)
MAX_RETRIES = 5

# Statuses after which a document counts as completed.
COMPLETED_STATUSES = ("success", "skipped")

# Asset kinds in the order in which a document's files are listed.
ASSET_KINDS = ("xml", "pdf", "zip", "media")


@dataclass(frozen=True)
class CrawlParams:
    """Parameters of one catalogue run.

    `base_path` is the URL path prefix in front of `/akn/...` at the source,
    `base_url` the full prefix requests are sent to. `current_year` is given,
    never read from the clock, so that a rerun gives the same rows.
    """

    base_path: str
    current_year: int
    base_url: str = ""
    output_dir: str = "corpus"
    categories: tuple[str, ...] = ("act",)
    years: int = 1
    years_by_category: dict[str, int | None] = field(default_factory=dict)
    lang_and_version: str = "fin@"
    limit: int = 10
    max_pages: int | None = None
    sleep_seconds: float = 5.0
    fetch_pdf: bool = False
    fetch_zip: bool = False
    fetch_media: bool = False
    force: bool = False
    dry_run: bool = False
    resume: bool = False
    reset: bool = False

    @property
    def asset_kinds(self) -> tuple[str, ...]:
        """Requested asset kinds; the XML always is."""
        wanted = (True, self.fetch_pdf, self.fetch_zip, self.fetch_media)
        return tuple(kind for kind, on in zip(ASSET_KINDS, wanted) if on)

    def years_back(self, category: str) -> int:
        """Years to go back; an override of 0 counts as not given."""
        return self.years_by_category.get(category) or self.years

    def year_window(self, category: str) -> tuple[int, int]:
        """First and last year; empty when the span is 0."""
        span = self.years_back(category)
        return self.current_year - span + 1, self.current_year


def requested_types(categories: tuple[str, ...] | list[str]) -> list[tuple[int, str, str, str]]:
    """(pass_no, requested, category, document_type) in request order.

    A type reached by two requests is listed twice; an unknown one never.
    """
    rows: list[tuple[int, str, str, str]] = []
    for requested in categories:
        if requested == AUTHORITY_TYPE:
            targets = [("doc", AUTHORITY_TYPE)]
        else:
            targets = [(requested, kind) for kind in DOCUMENT_TYPES.get(requested, [])]
        for category, kind in targets:
            rows.append((len(rows), requested, category, kind))
    return rows
