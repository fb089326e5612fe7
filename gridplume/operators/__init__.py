"""DataFrame operators: shaping, roll-up, chunks, snapshots, checks."""
