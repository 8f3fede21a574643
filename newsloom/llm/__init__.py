"""Training-data operators: each module holds one operator and its query; nothing else in the library imports this."""
