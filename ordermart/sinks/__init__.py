"""Tables: creation and writes."""
