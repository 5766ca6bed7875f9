"""Training-data operators; ``QUERIES`` and ``ORACLE`` are added to the
driver contract by ``__spark_entry__``."""

from importlib import import_module

MODULES = (
    "hard_negatives",
    "html_extract",
    "language_id",
    "license_scan",
    "ngram_join",
    "packing",
    "period_runs",
    "piece_codec",
    "pii",
    "quality_rules",
    "secret_scan",
    "site_quality",
    "decontaminate",
)

QUERIES = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"{__name__}.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(getattr(_module, "ORACLE", {}))
