"""Registered queries over the given tables, each with the SQL that states the same result."""

from millrace.plans import (  # noqa: F401  (importing registers the queries)
    history, jobs, joining, learning, nested, relational, storing, streams)
from millrace.plans.registry import REGISTRY, Query  # noqa: F401
