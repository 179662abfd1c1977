"""DataFrame-to-DataFrame operators: no sessions, no paths."""
