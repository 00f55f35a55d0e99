"""Customer-risk analytics as Spark jobs: checks, cleaning, encoding, models, experiments."""
