"""Tables and scene products."""
