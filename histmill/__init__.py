"""histmill: issue-tracker and revision-history migration analytics on Spark.

Every public helper takes and returns DataFrames; nothing is collected to the
driver except the frontier-emptiness test of the closure loop.
"""

from histmill.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
