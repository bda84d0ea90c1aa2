"""Operators: alignment joins, row-wise math/composites, window ops."""
