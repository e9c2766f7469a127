"""Spark-native analytics over network logs, an employee roster and business records."""
