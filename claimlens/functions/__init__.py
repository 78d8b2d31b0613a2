"""See README.md for the layout."""
