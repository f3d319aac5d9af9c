"""Audience and catalogue segmentation as composable Spark DataFrame operators."""
