"""Pipelines made of the operators, runnable with spark-submit."""
