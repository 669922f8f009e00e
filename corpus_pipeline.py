"""The document pipeline: quality classifier -> near duplicates -> decontamination -> secrets -> packing.

Its stages are part of the training-text operators; see ``spokes/llm/pipeline.py``.
"""

from spokes.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
