"""Sources: message lines from files, slots, brokers, and the driver tables."""
