"""HTML parsing into typed blocks."""
