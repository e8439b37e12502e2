"""Column-level functions: type mapping, instants, word sets."""
