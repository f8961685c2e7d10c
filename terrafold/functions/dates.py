"""Date helpers for delivery discovery and staging."""

from __future__ import annotations

import datetime as dt
import logging
import posixpath

from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

def upload_day(c) -> Column:
    """M2: ``last-updated`` text -> yyyyMMdd in the clock of the string.

    The text must be ``yyyy-MM-ddTHH:mm:ss.<1-6 digit fraction>Z``; anything
    else is NULL (``delivery.upload_date`` turns that into an error)."""
    c = F.col(c) if isinstance(c, str) else c
    whole = F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})\.\d{1,6}Z$", 1)
    ts = F.try_to_timestamp(F.nullif(whole, F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return F.date_format(ts, "yyyyMMdd")


def load_date_from_path(path: str, default: dt.date | None = None) -> dt.date:
    """The last path element parsed as yyyyMMdd; on failure the UTC
    date of now, with a warning (or ``default`` when given)."""
    leaf = posixpath.basename(path.rstrip("/"))
    if "=" in leaf:  # Hive-style partition folder file_date=yyyyMMdd
        leaf = leaf.split("=", 1)[1]
    try:
        return dt.datetime.strptime(leaf, "%Y%m%d").date()
    except ValueError:
        log.warning("input folder %r is not a date; using today's UTC date", path)
        return default or dt.datetime.now(dt.timezone.utc).date()

