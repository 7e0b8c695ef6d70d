"""The named jobs, each a function from frames to a frame."""
