"""Generic DataFrame operators: top-1 per group, frequency tie-break,
skew-safe numbering, crosstabs, interval / period joins, null-aware anti
joins, the as-of look-back and joined counts."""
