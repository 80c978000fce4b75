"""Import every catalogue module, in survey order."""

from tidemark.plans.catalog import aggregates, changes, control, dimensions, figures, joins, projections, quality, reconciliation, scalars, sources, streams  # noqa: F401
