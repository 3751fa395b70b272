"""reelrank: explicit-rating analytics and recommendation as Spark jobs.

Every operator takes and returns DataFrames; only scalars (a cut date, a
global mean, a count) ever reach the driver.
"""

from reelrank.config import Params

__all__ = ["Params"]
