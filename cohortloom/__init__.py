"""Spark-native building blocks for governed case/control study tables."""
