"""Reusable DataFrame operators: roll-ups, referential checks, profiles."""
