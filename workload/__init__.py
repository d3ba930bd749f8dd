"""Checked queries over the test tables: every module holds ``QUERIES`` and their ``ORACLES``."""
