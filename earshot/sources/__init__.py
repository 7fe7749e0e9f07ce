"""Reading and writing contacts."""
