"""Feeds and tables: readers, star-schema derivations, table writes."""
