"""Dataset operators: selection, request building, result handling, sinks."""
