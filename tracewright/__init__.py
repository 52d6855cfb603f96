"""Spark-first analytics over reasoning-chain training data."""
