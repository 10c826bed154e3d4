"""Column-expression helpers: parsers, time conversion, wire frames."""
