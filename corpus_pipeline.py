"""The corpus pipeline (language ID, line dedup, SimHash, mixing, packing); its stages are in gaugeworks/llm/pipeline.py."""

from gaugeworks.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
