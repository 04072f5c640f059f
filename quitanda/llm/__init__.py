"""Operators for training-data pipelines over documents, conversations and pages.

Nothing outside this subpackage imports it.  Each module holds one operator;
``catalog`` registers one query per operator.
"""
