"""Tables that tests and queries derive from the given star schema."""
