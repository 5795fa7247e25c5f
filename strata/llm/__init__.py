"""Operators of a training-data pipeline: decontamination, repeats, extraction, mixing, scoring, PII, near copies."""
