"""Page-view trends on Spark: DataFrame operators from hourly logs to top lists."""
