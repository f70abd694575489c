"""Text-dataset curation as Spark DataFrame operators and batch jobs."""
