"""Tables and files the engine reads and writes."""
