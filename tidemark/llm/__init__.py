"""Operators of a training-data pipeline: chat formatting, source mixing,
language ID, quality, deduplication, token counts, URL filters, sharding and
benchmark decontamination.  Nothing outside this package imports it."""
