"""Scalar expressions and name helpers."""
