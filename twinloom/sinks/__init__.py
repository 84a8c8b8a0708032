"""What the engine writes: staged tables, targets, query results, reports, the run catalogue."""
