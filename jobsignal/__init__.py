"""Job-posting and skill-demand analytics on Spark."""
