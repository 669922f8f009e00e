"""spokes — shared-mobility ride analytics expressed as Spark DataFrame jobs.

Layers:
    sources/    readers and fixture builders (trip CSVs, seeds, GeoJSON, census JSON)
    functions/  Column-expression builders (ride features, labels, geometry)
    operators/  DataFrame -> DataFrame operators (dedup, facts, marts, KPIs, zones, DQ)
    plans/      compositions of operators (refresh pipeline, query registry)
    streaming/  Structured Streaming twins of the incremental operators
"""

__all__ = ["session", "filters", "schemas"]
