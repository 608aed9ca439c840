"""Queries of this package by name, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict = {}
MODULES = ["simhash", "langid", "sharding", "secrets", "packing", "decontaminate", "maxent", "neighbours", "warc", "quality", "repair", "chat", "trie"]


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under ``name``."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"voxelframe.llm.{module}")
