"""Landed raw tables, test fixtures, CSV / JSON hand-off and index publishing."""
