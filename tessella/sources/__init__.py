"""Readers and writers: text CSV, JSON pages, HTML, captured crawls, versioned state."""
