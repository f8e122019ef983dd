"""quarry.operators."""
