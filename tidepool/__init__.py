"""Recommendation recall and ad analytics datasets, reports and models as Spark jobs."""
