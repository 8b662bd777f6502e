"""Spark-native dimensional warehouse: cleanse, load SCD dimensions and facts, check, serve."""
