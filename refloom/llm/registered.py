"""What the driver entry adds: the operators' queries and the pipeline."""

from __future__ import annotations

import corpus_pipeline

from refloom.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
SQL = queries.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
