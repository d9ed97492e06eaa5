"""Where source tables come from, and the small files the forecast reads and writes."""
