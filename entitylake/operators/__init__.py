"""DataFrame operators: search, facets, shaping, bodies, ranking and joins."""
