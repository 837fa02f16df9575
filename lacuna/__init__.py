"""Coverage-driven dataset curation on Spark."""
