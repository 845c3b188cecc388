"""Scalar functions, all built from native column expressions."""
