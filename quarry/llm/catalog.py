"""Queries of the training-data operators, one per operator."""

from __future__ import annotations

import importlib

from quarry.llm.registry import ORACLES, QUERIES

MODULES = ["decontaminate", "url_filter", "mixing", "langid_pieces", "secrets", "simhash", "sharding", "exact_dedup", "html_crf", "license_scan", "merkle", "whitening", "cross_polytope"]


def load():
    for m in MODULES:
        importlib.import_module(f"quarry.llm.{m}")
    return dict(QUERIES), dict(ORACLES)
