"""DataFrame in, DataFrame out. Nothing here reads or writes storage."""
