"""Plan-level building blocks: durable lineage cuts, hot-key handling,
distributed ordering, and the named views."""
