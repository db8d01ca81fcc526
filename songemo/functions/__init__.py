"""songemo package."""
