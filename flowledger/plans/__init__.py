"""Whole jobs that read and write tables, and the registered queries."""
