"""What the engine reads: staged tables, target schemas, SQL texts, reports, diagnostics."""
