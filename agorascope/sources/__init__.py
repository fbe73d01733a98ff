"""Tables, files and their schemas."""
