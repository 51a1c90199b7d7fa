"""Trip and congestion analytics as DataFrame-to-DataFrame operators on Spark."""
