"""Operators put together: the layered build, the reports, the registered queries."""
