"""Query plans over the test tables; importing registers every key."""

from tessera.plans.registry import ORACLES, QUERIES  # noqa: F401
from tessera.plans import (  # noqa: F401
    flagship,
    cleaning,
    relational,
    profiling,
    scalars,
    text,
    similarity,
    sampling,
    stats,
    metrics,
    io,
    models,
    neighbors,
)
