"""Readers, writers, views and keyed feature tables."""
