"""gridlake: DataFrame operators and layered plans for time-stamped energy data on Spark."""

from gridlake.session import plan_bytes, session, work_dir

__all__ = ["plan_bytes", "session", "work_dir"]
