"""Jobs: the algorithms by name and id, training over a grid, scoring, registered queries."""
