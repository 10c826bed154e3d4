"""DataFrame operators: windowed join, holdings, timeout, routing, upsert."""
