"""fluvia: landing, projection and corpus work on Spark."""
