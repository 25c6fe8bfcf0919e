"""clickscope: e-commerce click-log analytics as lazy Spark DataFrame plans.

Every public query takes DataFrames (the action log and its user, product and
city dimensions) plus typed parameters and returns a DataFrame. Nothing is
collected to the driver; the caller decides when to act and where to write.
"""

from clickscope.conditions import Condition
from clickscope.session import build_session, checkpoint_dir

__all__ = ["Condition", "build_session", "checkpoint_dir"]
