"""DataFrame operators: joins, ranking, sampling, labelling, scoring and formatting."""
