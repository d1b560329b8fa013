"""Readers and writers for catalogs, feeds, evidence, ledgers and reports."""
