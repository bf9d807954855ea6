"""Transaction-risk features, scoring and evaluation as Spark jobs."""
