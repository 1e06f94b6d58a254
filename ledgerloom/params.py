"""Settings of one reconciliation run. They reach the operators as plain literals."""

from __future__ import annotations

import datetime as dt
import tomllib
from dataclasses import dataclass, field, fields, replace
from decimal import Decimal
from typing import Any

# Default commission rates by transaction type, subtotal last.
DEFAULT_CHARGE_RATES = {
    "normal": Decimal("0.0185"),
    "3期": Decimal("0.0185"),
    "6期": Decimal("0.018"),
    "12期": Decimal("0.017"),
    "24期": Decimal("0.015"),
    "小計": Decimal("0.0185"),
}


def _as_date(value: Any) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class ReconParams:
    beg: dt.date
    end: dt.date
    last_beg: dt.date
    last_end: dt.date
    enabled_banks: tuple[str, ...] = ("cub", "ctbc", "nccc", "ub", "taishi")
    main_store: str = "主公司"
    charge_rates: dict[str, Decimal] = field(default_factory=lambda: dict(DEFAULT_CHARGE_RATES))
    tax_rate: Decimal = Decimal("0.05")
    claimed_adjustments: dict[str, Decimal] = field(default_factory=dict)
    fee_rounding: dict[str, Decimal] = field(default_factory=dict)
    revenue_deduction: Decimal = Decimal("150000")
    tolerance: Decimal = Decimal("1")
    cod_remittance_fee: Decimal = Decimal("0")
    ach_expense: Decimal = Decimal("0")
    ctbc_rebate: Decimal = Decimal("0")
    special_receipts: dict[str, Decimal] = field(default_factory=dict)
    opening_balances: dict[str, Decimal] = field(default_factory=dict)
    reversal_amounts: dict[str, Decimal] = field(default_factory=dict)
    special_entries: dict[str, list[dict]] = field(default_factory=dict)
    skip_zero_amount: bool = False
    amount_places: int = 2

    def __post_init__(self) -> None:
        for name in ("beg", "end", "last_beg", "last_end"):
            object.__setattr__(self, name, _as_date(getattr(self, name)))
        if self.beg > self.end or self.last_beg > self.last_end:
            raise ValueError("a period must not start after its end")

    @property
    def month_beg(self) -> dt.date:
        return self.beg.replace(day=1)

    @property
    def next_month_beg(self) -> dt.date:
        return (self.month_beg + dt.timedelta(days=32)).replace(day=1)

    @property
    def period(self) -> str:
        return self.beg.strftime("%Y-%m")

    def with_(self, **changes: Any) -> "ReconParams":
        return replace(self, **changes)

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> "ReconParams":
        """Build from parsed settings; money and rates become exact decimals."""
        known = {f.name: f for f in fields(cls)}
        out: dict[str, Any] = {}
        for key, value in raw.items():
            if key not in known:
                raise KeyError(f"unknown setting: {key}")
            if key == "enabled_banks":
                out[key] = tuple(value)
            elif isinstance(value, dict) and key != "special_entries":
                out[key] = {k: Decimal(str(v)) for k, v in value.items()}
            elif isinstance(value, (int, float)) and not isinstance(value, bool) and key != "amount_places":
                out[key] = Decimal(str(value))
            else:
                out[key] = value
        return cls(**out)

    @classmethod
    def from_toml(cls, path: str) -> "ReconParams":
        with open(path, "rb") as handle:
            return cls.from_dict(tomllib.load(handle))
