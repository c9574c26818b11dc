"""Imports every query module so the registry is complete."""

from __future__ import annotations

import importlib

MODULES = ["q_profile", "q_text", "q_grade", "q_sampling", "q_curate", "q_synth", "q_validate", "q_io", "q_langid", "q_tokenizer", "q_jobs"]


def load_all():
    for m in MODULES:
        importlib.import_module(f"quarry.plans.{m}")
    from quarry.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
