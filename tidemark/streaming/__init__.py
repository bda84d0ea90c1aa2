"""Structured Streaming: request messages in, metric outputs + ledger out."""
