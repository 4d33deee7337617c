"""Registered queries: each name carries a Spark job and, where SQL can say it, an oracle."""

from .registry import REGISTRY, Tables, query  # noqa: F401
from . import (  # noqa: F401  (importing a module registers its queries)
    profiling,
    cleaning,
    joining,
    aggregating,
    windowing,
    loading,
    documents,
    texts,
    expressions,
    files,
    generating,
    streams,
)
