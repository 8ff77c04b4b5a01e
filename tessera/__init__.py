"""tessera: financial text and fund analytics as Spark DataFrame jobs.

Every public operator takes DataFrames (plus small, explicit parameters) and
returns a DataFrame.  Nothing is collected to the driver; word lists, look-back
windows and other configuration are passed in as (small) DataFrames or plain
Python values and become literals / broadcast sides of the plan.
"""

from tessera.session import get_session, checkpoint_dir, cut_lineage  # noqa: F401

__all__ = ["get_session", "checkpoint_dir", "cut_lineage"]
