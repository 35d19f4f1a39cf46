"""Operators put together: the redaction pipeline and the registered queries."""
