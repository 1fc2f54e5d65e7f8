"""Scientific-document analytics and training-data preparation on Spark."""
