"""Starting streams, and operators that need Spark's keyed state."""
