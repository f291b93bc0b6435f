"""Column functions: transit times, dates and the checks that semantic types are made of."""
