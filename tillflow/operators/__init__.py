"""Batch operators, and stateless operators that also take streaming frames."""
