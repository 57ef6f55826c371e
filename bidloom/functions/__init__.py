"""Column-level building blocks: regex capture, parsing, exact ranks and quantiles."""
