"""Sources (rating text, order tables) and sinks (JSON report)."""
