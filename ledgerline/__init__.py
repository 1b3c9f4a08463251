"""Spark-native jobs for financial research panels and training-data corpora."""
