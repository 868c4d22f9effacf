"""Starting, landing and reading back streaming results."""
