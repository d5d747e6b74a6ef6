"""Reading and writing of layers."""
