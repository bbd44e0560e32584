"""DataFrame-level operators: dedup, keywords, vectors, clustering, profiles,
scoring, ranking, keyed results and the enrichment plug-in."""
