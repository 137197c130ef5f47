"""Random forests on distributed MLlib: fit, search, store and score."""
