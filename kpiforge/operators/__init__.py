"""Operators: one function per reference CTE / business measure."""
