"""Scalar/column expressions: grid geometry and attribute parsing."""
