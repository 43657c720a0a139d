"""Timestamp, URI and JSON column helpers (ST-13..ST-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def readable_timestamp(ts: Column) -> Column:
    """ST-14: ``August 11, 2023 08:18:59 AM``."""
    return F.date_format(ts, "MMMM dd, yyyy hh:mm:ss a")


def path_timestamp(ts: Column) -> Column:
    """ST-15: ``2023-08-11_08-13-23``."""
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def tune_timestamp(ts: Column) -> Column:
    """ST-15, tuning variant: ``2023_08_11_08_13_23``."""
    return F.date_format(ts, "yyyy_MM_dd_HH_mm_ss")


def uri_path(uri: Column) -> Column:
    """ST-13: the path component of a URI; NULL for unparsable input."""
    return F.try_parse_url(uri, F.lit("PATH"))


def parse_config(text: Column, schema: str) -> Column:
    """ST-16: JSON text -> struct of the given DDL schema (NULL when invalid)."""
    return F.from_json(text, schema)
