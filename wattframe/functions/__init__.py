"""See the module docstrings in this subpackage."""
