"""Sinks: JSON Lines results, versioned output manifests, run ledger."""
