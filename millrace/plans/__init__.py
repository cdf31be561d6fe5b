"""All registered queries of the timing, replay, text, tensor, file and streaming jobs."""

from millrace.functions import cards, text
from millrace.operators import containment, gates, intervals, policies, probes, refine, replay, scoring, search, tensor, timing
from millrace.registry import ORACLE_SQL, QUERIES
from millrace.sources import evidence, ledger
from millrace.streaming import jobs

__all__ = ["ORACLE_SQL", "QUERIES", "cards", "containment", "evidence", "gates", "intervals", "jobs", "ledger", "policies", "probes", "refine", "replay", "scoring", "search", "tensor", "text", "timing"]
