"""Ready-made sales queries."""
