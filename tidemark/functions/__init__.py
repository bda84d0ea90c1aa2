"""Column-level scalar functions (JVM-side, no UDFs)."""

from tidemark.functions.numeric import clean, finite, ieee_divide

__all__ = ["clean", "finite", "ieee_divide"]
