"""Configuration, lineage and commands: what runs on the driver."""
