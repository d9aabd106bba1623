"""Where lines come from."""
