"""Tables in and out."""
