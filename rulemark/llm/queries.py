"""All queries of the subpackage."""

from rulemark.llm import conversations, decontamination, exact_dedup, hard_negatives, html_text, language, licenses, mixing, packing, pii, sharding, simhash, url_filter  # noqa: F401
from rulemark.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
