"""shelfspark: retail feature, model-data and drift operators on Spark DataFrames.

Every public function takes DataFrames and column names and returns a
DataFrame (or a small fitted object whose data also lives in DataFrames).
Heavy work stays in Spark; the driver only sees k-row statistics.
"""

from shelfspark.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
