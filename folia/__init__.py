"""folia: Spark jobs for document shaping, catalog reads and changes,
profiling and preparation, and classifier training and comparison."""
