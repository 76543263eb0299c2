from .schema import TXN_SCHEMA, REQUEST_SCHEMA, METRICS_SCHEMA  # noqa: F401
from .tables import read_table, txn_frame  # noqa: F401
