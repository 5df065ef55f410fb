"""Rule lists (fixed values) and the column builders that turn them into
Catalyst expressions."""
