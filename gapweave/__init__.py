"""Consolidate drifting record extracts and complete their missing fields, on Spark."""

from gapweave.config import CompletionConfig, ConsolidationConfig
from gapweave.plans.complete import complete, run_completion
from gapweave.plans.consolidate import consolidate, run_consolidation

__all__ = [
    "CompletionConfig",
    "ConsolidationConfig",
    "complete",
    "consolidate",
    "run_completion",
    "run_consolidation",
]
