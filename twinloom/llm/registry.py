"""What the driver contract adds when this subpackage is present."""

from __future__ import annotations

import corpus_pipeline
from twinloom.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLES = queries.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
