"""Spark-native analytics for pooled perturbation screens and text corpora."""
