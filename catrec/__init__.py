"""catrec: metastore catalogue -> change records, and reconciliation of
record sets, as Spark DataFrame operators.

Subpackages: ``functions`` (Column builders), ``sources`` (snapshot, JDBC
and record-file scans), ``operators`` (catalogue, events, gates,
reconciliation), ``sinks`` (record files, snapshots, file-system helpers),
``plans`` (jobs, test-data adapter, registered queries, SQL oracle).
"""

from catrec.options import CatalogueOptions, parse_byte_size

__all__ = ["CatalogueOptions", "parse_byte_size"]
