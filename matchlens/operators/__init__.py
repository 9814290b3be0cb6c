"""DataFrame operators: each takes frames and parameters and returns a frame."""
