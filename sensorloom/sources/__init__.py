"""Feeds, delimited files, tables and the zone layout."""
