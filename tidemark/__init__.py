"""tidemark: report-ready marts on Spark.

Every public operator is a function ``DataFrame -> DataFrame`` built from
built-in Spark expressions, so Catalyst can prune, push down and fuse the
whole chain into one plan. Time is explicit: functions take ``as_of`` /
``now`` / ``hwm`` arguments instead of reading the wall clock.
"""

from tidemark.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
