"""Column functions: text repair, tab stops, regex dialect, versions, JSON."""
