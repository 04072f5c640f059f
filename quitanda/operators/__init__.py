"""Reusable DataFrame operators: joins, numbering, data-quality checks."""
