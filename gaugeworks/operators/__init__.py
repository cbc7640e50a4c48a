"""DataFrame operators: lazy, no clock, no collect, column names as parameters."""
