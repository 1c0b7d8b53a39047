"""Operators, grouped as in the survey; importing the package registers their queries."""

from . import aggregates, filters, helpers, joins, pairs, projections, quality, relational, spans, texts, windows  # noqa: F401
