"""kpiforge: customer-grain KPI tables, reconciliation, monthly activity
status and column contracts, written as plain PySpark DataFrame functions.

Every operator takes DataFrames (and an explicit ``as_of`` where the result
depends on the clock) and returns a lazy DataFrame; nothing is collected.
"""

from kpiforge.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
