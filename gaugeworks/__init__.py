"""Spark-native engine for data-quality findings."""
