"""Landing archives as they arrive. Nothing else in these jobs is a stream."""
