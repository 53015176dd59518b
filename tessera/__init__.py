"""tessera: Spark-native short-text classification analytics.

Every operator is a function from DataFrame to DataFrame, keyed by
``doc_id``.  Text functions return Columns that stay inside whole-stage
codegen; aggregations, joins and windows are declared with the DataFrame
API so Catalyst plans them.
"""

from tessera.session import get_session, checkpoint_dir, materialize  # noqa: F401

__all__ = ["get_session", "checkpoint_dir", "materialize"]
