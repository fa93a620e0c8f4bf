"""Column-level building blocks: keys, time arithmetic, units, labels, patterns."""
