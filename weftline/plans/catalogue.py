"""All queries and oracles; importing the modules registers them."""

from __future__ import annotations

from weftline.plans import agents, files, grids, messages, more, records, replies, retrieval, scores, texts  # noqa: F401
from weftline.plans.registry import ORACLES, QUERIES  # noqa: F401
