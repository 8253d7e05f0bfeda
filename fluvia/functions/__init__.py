"""Scalar work: casts with errors as values, the mapping language, redaction."""
