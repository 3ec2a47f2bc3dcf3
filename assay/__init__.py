"""assay: tabular scoring analytics on Spark (profiling, features, models, explanation)."""
