"""Feature families: named columns composed from the window primitives."""
