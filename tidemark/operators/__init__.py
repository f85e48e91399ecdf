"""DataFrame operators: shaping, quality, statistics, comparison and marts."""
