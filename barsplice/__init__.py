"""Splicing-assay analytics on barcoded minigene libraries, as Spark DataFrame jobs."""
