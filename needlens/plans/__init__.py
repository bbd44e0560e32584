"""Composed stages (collect, topic clustering, needs, specs), the full run,
and the driver queries with their oracle SQL."""
