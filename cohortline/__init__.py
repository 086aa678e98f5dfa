"""Customer-retention analytics on Spark DataFrames."""

from cohortline.config import RetentionConfig

__all__ = ["RetentionConfig"]
