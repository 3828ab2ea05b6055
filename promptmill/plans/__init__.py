"""Whole plans: raw lines to split chat records, chat records to training text."""

from promptmill.plans.prepare import PrepareConfig, Prepared, prepare, prepare_files
from promptmill.plans.training import training_blocks, training_text, write_training_blocks, write_training_shards

__all__ = [
    "PrepareConfig",
    "Prepared",
    "prepare",
    "prepare_files",
    "training_blocks",
    "training_text",
    "write_training_blocks",
    "write_training_shards",
]
