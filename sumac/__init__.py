"""sumac: table analytics and machine-learning steps as plain Spark jobs."""
