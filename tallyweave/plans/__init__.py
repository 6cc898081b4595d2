"""Query plans over the given tables."""

PLAN_MODULES = ["facts", "history", "web", "queues", "cover", "files", "rules", "sinks", "streams"]
