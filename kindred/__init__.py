"""kindred: embedding, similarity linking and document search as Spark jobs.

Every public function takes DataFrames and returns DataFrames; the heavy work
(scans, model batches, similarity joins, merges, ranking) runs on executors.
"""

from kindred.session import build_session, new_work_path, work_root

__all__ = ["build_session", "new_work_path", "work_root"]
