"""Plan fragments shared by several operators."""
