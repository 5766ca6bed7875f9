"""strata - layered (bronze / silver / gold) batch analytics on Spark.

Pure ``DataFrame -> DataFrame`` transforms for raw account, customer,
product and order feeds, plus the table operations around them (overwrite,
keyed upsert, table documentation) and an incremental intake.

Main entry points::

    from strata import accounts, sales            # layer transforms
    from strata import global_rank, upsert, split  # operators
    from strata import save_overwrite, save_upsert, document_table
    from strata import run_accounts_job, run_sales_job
"""

from strata.operators.quality import Rule, split
from strata.operators.ranking import Ranking, global_rank, global_ranks, rank_measures
from strata.operators.upsert import keep_last, upsert
from strata.plans import accounts, sales
from strata.plans.jobs import run_accounts_job, run_sales_job
from strata.session import SCALE_SETTINGS, build_session
from strata.sources.tables import TableDoc, document_table, save_overwrite, save_upsert

__version__ = "0.1.0"

__all__ = [
    "Rule",
    "SCALE_SETTINGS",
    "TableDoc",
    "accounts",
    "build_session",
    "document_table",
    "global_rank",
    "global_ranks",
    "rank_measures",
    "Ranking",
    "keep_last",
    "run_accounts_job",
    "run_sales_job",
    "sales",
    "save_overwrite",
    "save_upsert",
    "split",
    "upsert",
]
