"""Jobs: reading a layer, deriving the next one, checking it and writing it."""
