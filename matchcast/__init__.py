"""matchcast: win-probability scoring and model evaluation as Spark jobs."""
