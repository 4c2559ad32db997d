"""DataFrame-level operators: joins (lookup broadcast, hot-key split), aggregates, ordering."""
