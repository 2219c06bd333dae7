"""Sources: table scans, file listings, message payload decoding, log catalog."""
