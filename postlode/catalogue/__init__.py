"""Named queries over the tables of a folder, and the SQL that gives the same rows."""

from postlode.catalogue import cases, on_dedup, on_lookups, on_postings, on_profiles, on_records, on_streams, on_tables
from postlode.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cases", "on_dedup", "on_lookups", "on_postings", "on_profiles", "on_records", "on_streams", "on_tables"]
