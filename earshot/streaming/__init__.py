"""The row-wise stages over a stream of contact files."""
