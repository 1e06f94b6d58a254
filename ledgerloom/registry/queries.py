"""All registered queries; importing a module adds its queries."""

from ledgerloom.registry import q_cleaning, q_fees, q_ledger, q_statements, q_tables, q_trust  # noqa: F401
from ledgerloom.registry.core import REGISTRY

__all__ = ["REGISTRY"]
