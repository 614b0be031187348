"""Scalar column functions (F1-F15) used by the operators."""
