"""Star-schema builders, quality checks, analytics and the pipeline."""
