"""DataFrame-to-DataFrame operators. All are lazy and none holds a whole point in one task."""
