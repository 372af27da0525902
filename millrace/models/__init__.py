"""Regression models on Spark ML."""
