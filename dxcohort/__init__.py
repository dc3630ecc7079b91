"""dxcohort: cohort outcome analytics over diagnosis-code arrays, on Spark.

Every public function takes and returns Spark DataFrames and is built
from built-in DataFrame expressions, so Catalyst and adaptive query
execution choose the physical plan.
"""

from dxcohort.session import build_session, ensure_checkpoint_dir, scratch_path

__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path"]
