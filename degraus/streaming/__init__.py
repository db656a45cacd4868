"""Event streams: key validation, split into stored and rejected events, monitoring."""
