"""See the package."""
