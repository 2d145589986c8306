"""Scalar operators. All are Column expressions, so they stay in generated code."""
