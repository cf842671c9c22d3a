"""DataFrame -> DataFrame operators (one logical plan each; no driver data)."""
