"""DataFrame operators: resolve, hierarchy, quality, star schema, reports, contract, increments."""
