"""Readers and writers: CSV exports, stored tables, rule files, star-schema adapter."""
