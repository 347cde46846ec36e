"""DataFrame operators: flattening, latest rows, ordered neighbours, quantiles, spines."""
