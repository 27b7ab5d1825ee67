"""Plan-level techniques: skew-safe windows, exact quantiles, cut lineage, the batch flow."""
