"""HTTP-trace analytics on Spark: ingest, dashboards, graph, detectors, upkeep."""
