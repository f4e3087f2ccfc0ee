"""Operators put together: daily runs over stored tables and the sample queries."""
