"""Table reads, writes and the retail tables derived from the driver tables."""
