"""Record and triple sources."""
