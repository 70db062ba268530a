"""Scalar column functions (pure Column -> Column helpers, all JVM-side)."""
