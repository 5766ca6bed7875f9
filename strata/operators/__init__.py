"""Relational operators Spark lacks as one call: global rank, keyed upsert,
rule-based quality split."""
