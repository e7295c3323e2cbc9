"""Operators of a training-data pipeline: personal data, token counts, BPE,
licences, nearest neighbours, line and document dedup, toxicity, benchmark
decontamination and language identification. Nothing else in the library
imports this subpackage."""
