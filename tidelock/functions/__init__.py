"""Part of tidelock."""
