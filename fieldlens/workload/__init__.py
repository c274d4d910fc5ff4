"""Registered queries over the driver tables, each with its equivalent SQL where SQL can say it."""

from fieldlens.workload import cleaning, imagery, ingest, learning, relations, statistics  # noqa: F401
from fieldlens.workload.registry import ORACLES, QUERIES  # noqa: F401
