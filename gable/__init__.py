"""Gable: marketplace-listing analytics expressed as Spark DataFrame jobs."""
