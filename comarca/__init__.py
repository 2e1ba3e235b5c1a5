"""comarca: Spark operators for official statistics about places.

``functions``  column expressions (text keys, exact ratios, class ladders)
``operators``  DataFrame -> DataFrame building blocks
``sources``    scans, file metadata, web pages, lineage, and table sinks
``plans``      staged tables, yearly rollup, marts, dashboard and checks
``streaming``  exactly-once intake of newly arrived files
"""
