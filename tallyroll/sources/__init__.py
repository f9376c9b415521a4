"""Reading source files and reading and writing the Bronze, Silver and Gold layers."""
