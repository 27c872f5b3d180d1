"""DataFrame operators: transforms, profiling, features, ranks, statistics, drift, model data."""
