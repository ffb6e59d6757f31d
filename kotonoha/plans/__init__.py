"""Plan-level building blocks: numbering, layout, state views, the store."""
