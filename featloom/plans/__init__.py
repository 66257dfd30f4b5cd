"""Plan-level helpers: sizing, skew-proof joins, ordered prefixes, spec fusion."""
