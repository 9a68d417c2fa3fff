from . import aggregates, cells, evaluation, joins, learning, quality, scans, statistics  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
