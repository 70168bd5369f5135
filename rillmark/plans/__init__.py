"""Jobs: the order in which operators, gates and sinks run."""
