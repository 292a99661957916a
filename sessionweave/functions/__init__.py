"""Scalar expressions: identities, splits and text rules."""
