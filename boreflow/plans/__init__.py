"""Stand-in inputs over the driver tables, the pipeline of layers, the query
registry with its oracle SQL, and the end-to-end run over input files."""
