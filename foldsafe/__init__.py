"""foldsafe: leak-safe, distributed ML data operators on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame. Fitted state
(medians, centres, cut points) is a bounded set of scalars or a small
DataFrame; nothing proportional to the row count passes through the driver.
"""

from foldsafe.session import get_session, checkpoint_dir, read_table

__all__ = ["get_session", "checkpoint_dir", "read_table"]
