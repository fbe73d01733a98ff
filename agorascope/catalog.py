"""All queries by name, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from agorascope.queries import dashboard, kept, more, operators

QUERIES = dashboard.QUERIES | operators.QUERIES | more.QUERIES | kept.QUERIES
ORACLES = dashboard.ORACLES | operators.ORACLES | more.ORACLES | kept.ORACLES
FLAGSHIP = "post_distribution"
