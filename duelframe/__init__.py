"""Spark-native analytics over a battle-video catalogue."""
