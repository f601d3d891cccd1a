"""Operators on text corpora: deduplication, filtering, extraction, scoring, tokenization, archives."""
