"""Metadata-driven ingestion, data-quality and corpus operators as Spark jobs."""
