"""Writers, keyed upserts and run logs."""
