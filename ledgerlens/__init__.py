"""ledgerlens: retail sales analytics expressed as Spark DataFrame plans.

Every public operator is a plain function from DataFrames to a DataFrame.
Nothing is collected to the driver except single scalars (the ``as_of``
instant and size checks on dimension tables).
"""

from ledgerlens.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
