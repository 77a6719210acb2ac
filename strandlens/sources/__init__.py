"""Readers of sequencing files, reference tables and workbooks."""
