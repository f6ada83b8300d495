"""tributary: a PySpark-native engine of table and stream operators.

Every operator takes and returns a Spark DataFrame (or a Column for the
scalar helpers in ``tributary.functions``).  Nothing is collected to the
driver except one-row aggregates and metadata.
"""

from tributary.session import build_session, checkpoint_dir, ship_package  # noqa: F401

__version__ = "0.1.0"
