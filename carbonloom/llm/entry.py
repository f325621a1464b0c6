"""What the entry module registers of this folder."""

from __future__ import annotations

import corpus_pipeline
from carbonloom.llm.oracle import ORACLES as SQL
from carbonloom.llm.queries import QUERIES as NUMBERED

QUERIES = dict(NUMBERED) | {"pipeline": corpus_pipeline.run}
ORACLES = dict(SQL)
