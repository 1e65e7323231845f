"""Classification of HTTP outcomes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lawgrain.params import RETRY_STATUSES


def is_retryable(http_status: Column) -> Column:
    """Whether a status is one that is tried again; FALSE for a missing one."""
    return F.coalesce(http_status.isin(*RETRY_STATUSES), F.lit(False))


def response_class(http_status: Column) -> Column:
    """`rate_limited` for 429, `http_error` from 400 on, else `ok`; NULL stays."""
    return (
        F.when(http_status == 429, "rate_limited")
        .when(http_status >= 400, "http_error")
        .when(http_status.isNotNull(), "ok")
    )
