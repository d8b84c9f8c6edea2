"""The daily run fed by a file stream."""
