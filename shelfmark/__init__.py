"""shelfmark: pricing and markdown analytics expressed as Spark DataFrame plans.

Every operator is a function from DataFrames to a DataFrame.  Nothing in the
library collects rows to the driver; the only actions happen in sinks, tests
and the benchmark.
"""

from shelfmark.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
