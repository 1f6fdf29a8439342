"""Operators for training-data pipelines over text corpora."""

from __future__ import annotations

from importlib import import_module

MODULES = ["fingerprint", "near_dedup", "mixing", "sharding", "chat", "decontam", "html_extract", "langid", "url_filter", "warc"]


def queries() -> dict:
    return {k: v for name in MODULES for k, v in import_module(f"{__name__}.{name}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for name in MODULES for k, v in import_module(f"{__name__}.{name}").SQL.items()}
