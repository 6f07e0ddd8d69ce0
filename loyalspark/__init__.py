"""loyalspark — point-in-time customer-engagement analytics on Spark.

Operators take and return DataFrames and stay inside native Spark
expressions: daily / rolling active users, recency life-cycle states,
frequency-value segmentation, dated snapshots and backfills, feature
stores, label and cohort construction, and Spark ML training and scoring.
"""

from loyalspark.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
