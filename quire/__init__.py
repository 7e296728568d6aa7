"""quire — corpus preparation as Spark DataFrame operators.

Every operator is either ``Column -> Column`` (``quire.functions``) or
``DataFrame -> DataFrame`` (``quire.operators``), so stages chain with
``DataFrame.transform``.  Nothing is collected to the driver except bounded
metadata (range boundaries, per-bucket totals, parameter-sized lists).
"""

__version__ = "0.1.0"
