"""quarry.streaming."""
