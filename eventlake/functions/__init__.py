"""Scalar expressions that several operators share."""
