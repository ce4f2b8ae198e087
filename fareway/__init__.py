"""Trip and road analytics as typed DataFrame and stream operators on Spark."""
