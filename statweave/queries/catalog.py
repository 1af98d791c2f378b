"""All registered queries."""

from statweave.queries import closed_forms, evaluation, models, relational, scaled, statistics, streams, vectors  # noqa: F401
from statweave.queries.registry import ORACLES, QUERIES  # noqa: F401
