"""Tables and streams in and out."""
