"""Instruction-data preparation, token accounting and evaluation tables on Spark."""
