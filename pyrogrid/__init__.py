"""Analytics over very large tables of timestamped point observations, as plain DataFrame functions."""
