"""All queries of the library's own operators."""

from textloom.operators import aggregates, filters, joins, retrieval, reports, sets, windows  # noqa: F401
from textloom.functions import numbers, text  # noqa: F401
from textloom.plans import integrity, links, models, release, selection  # noqa: F401
from textloom.sources import files  # noqa: F401
from textloom.streaming import queue, states  # noqa: F401
from textloom.registry import COVERS, ORACLES, QUERIES  # noqa: F401
