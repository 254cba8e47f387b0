"""Commercial sales analytics as DataFrame-to-DataFrame operators on Spark."""
