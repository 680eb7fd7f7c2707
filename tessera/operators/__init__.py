"""Table operators that add something to a single Spark call: a defined
surviving row, a deterministic tie-break, one-pass reports, size-aware
joins."""
