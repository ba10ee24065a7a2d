"""Query plans: the registered queries, their oracle SQL and end-to-end jobs."""

from . import catalog, flagship  # noqa: F401  (registers the flagship query)
