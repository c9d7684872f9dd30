"""Part of streamcurate."""
