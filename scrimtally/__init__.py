"""Team-versus-team match analytics as Spark DataFrame transformations.

Layout:

* ``functions``  pure ``Column`` helpers (metrics, Wilson bounds, clean-up)
* ``sources``    readers and writers
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      star schema, marts, report queries and batch stages
* ``streaming``  incremental document ingest
"""
