"""Period-end payment reconciliation and ledger preparation on Spark DataFrames."""

from ledgerloom.params import ReconParams

__all__ = ["ReconParams"]
