"""Table operators: constraints, flattening, service days, stop times."""
