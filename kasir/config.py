"""Run configuration.

Every constant the sales and menu jobs depend on is a field here, so a caller
can re-point a job (other labels, other cut-over dates, other as-of day)
without touching the job code. Defaults are the production values.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These must equal the production labels and numbers for the
# results to be right. Listed in their original order.
# ---------------------------------------------------------------------------

# Modern (bill-level) feed: Visit Purpose -> channel.
VISIT_PURPOSE_CHANNELS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("OFFLINE", ("01.DINE IN", "02.TAKE AWAY", "06.COMPLIMENT")),
    ("GOFOOD", ("03.GOFOOD INT",)),
    ("GRABFOOD", ("04.GRAB FOOD INT",)),
    ("SHOPEEFOOD", ("05.SHOPEE FOOD INT",)),
)

# Legacy (pre-aggregated) feed: tender / order type -> channel. The same
# mapping is applied to the money table and to the transaction-count table.
TENDER_CHANNELS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("OFFLINE", (
        "EDC", "CASH", "RESERVASI", "COMPLIMENT", "QRIS SHOPEE", "CLOUD VOUCHER",
        "OTHERS", "VOUCHER", "EDC CIMB", "QRIS ESB ORDER TABLE", "OVO", "DEBIT BCA",
        "QRIS ESB KIOSK", "VISA CARD", "EDC NIAGA", "QRISIA", "QRIS TELKOM", "TUNAI",
        "MASTER CARD", "FLAZZ", "EDC BRI QRIS", "SHOPEE", "QRIS BNI", "QRIS", "GOPAY",
    )),
    ("GRABFOOD", ("GRAB FOOD", "GRAB_FD")),
    ("SHOPEEFOOD", ("SHOPEEPAY", "SHOPEE PAY", "SHOPEEFOOD INT")),
    ("GOFOOD", ("GO RESTO", "GOFOOD", "GORESTO")),
    ("OTHER ONLINE", ("OKJEK", "AIRASIA FOOD")),
)

UNKNOWN_CHANNEL = "Unknown"

# Channels counted as ONLINE; every other channel (incl. OTHER ONLINE and
# Unknown) is OFFLINE.
ONLINE_CHANNELS: tuple[str, ...] = ("GOFOOD", "GRABFOOD", "SHOPEEFOOD")
ONLINE_GROUP = "ONLINE"
OFFLINE_GROUP = "OFFLINE"

TAX_DIVISOR = 1.1
COHORT_OPEN_FROM = "2024-10-01"
COHORT_DAYS = 90
SAME_YEAR_FROM = "2025-01-01"
LEGACY_MENU_UNTIL = "2025-05-31"
YEAR_FLOOR = 2022
YEAR_WHEN_NULL = 2016
OVERRIDE_CODE = "HOMAL1"
OVERRIDE_NAME = "HO MALANG"

# Store attributes carried onto the sales marts (order as published).
STORE_ATTRS: tuple[str, ...] = (
    "OPEN_STORE", "NAMA_OPS", "AREA_HEAD", "RM", "CITY", "AM", "PROVINSI", "KOTA",
    "JAVA___OUTER_JAVA", "TYPE_KITCHEN", "STATUS", "CODE_GIS",
)
# Store attributes carried onto the menu marts (no CODE_GIS).
MENU_STORE_ATTRS: tuple[str, ...] = STORE_ATTRS[:-1]
# Store attributes on the target tracker.
TRACKER_STORE_ATTRS: tuple[str, ...] = (
    "OPEN_STORE", "STORE", "PROVINSI", "KOTA", "JAVA___OUTER_JAVA", "AREA_HEAD",
)
# Attributes kept by the same-year cohort.
SAME_YEAR_ATTRS: tuple[str, ...] = (
    "NAMA_OPS", "OPEN_STORE", "PROVINSI", "KOTA", "JAVA___OUTER_JAVA",
)


def _as_date(v: str | _dt.date | None) -> _dt.date | None:
    if v is None or isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(v)


@dataclass(frozen=True)
class Config:
    visit_purpose_channels: tuple = VISIT_PURPOSE_CHANNELS
    tender_channels: tuple = TENDER_CHANNELS
    unknown_channel: str = UNKNOWN_CHANNEL
    online_channels: tuple = ONLINE_CHANNELS
    tax_divisor: float = TAX_DIVISOR
    # daily1 divides the lagged net by the tax divisor a second time; the
    # other grains do not. Kept as a parameter so the quirk is visible.
    daily_channel_lag_divisor: float = TAX_DIVISOR
    cohort_open_from: _dt.date = field(default_factory=lambda: _as_date(COHORT_OPEN_FROM))
    cohort_days: int = COHORT_DAYS
    same_year_from: _dt.date = field(default_factory=lambda: _as_date(SAME_YEAR_FROM))
    legacy_menu_until: _dt.date | None = field(default_factory=lambda: _as_date(LEGACY_MENU_UNTIL))
    year_floor: int = YEAR_FLOOR
    year_when_null: int = YEAR_WHEN_NULL
    override_code: str = OVERRIDE_CODE
    override_name: str = OVERRIDE_NAME
    # None = UTC current_date() at run time.
    as_of: _dt.date | None = None
    # Money enters as this decimal so sums do not depend on row order; raw
    # amounts keep six decimals.
    money_type: str = "decimal(24,6)"
    # Net sales after the legacy tax strip are held at 6 decimals.
    net_type: str = "decimal(38,6)"
    # Partitions of the store-clustered stage (hash of RESTO) and buckets of
    # the published daily marts. None = spark.sql.shuffle.partitions buckets, and
    # partitions of the advisory size.
    store_partitions: int | None = None
    # Joins of the raw feeds to their dimensions: None = by the planner's
    # sizes; a number of bytes = measured, broadcast up to it, and beyond it
    # with heavy hitters split.
    split_dimensions_above: int | None = None
    # Previous values over ranges, for series too long for one task.
    ranged_previous: bool = False

    def with_(self, **kw) -> "Config":
        for k in ("cohort_open_from", "same_year_from", "legacy_menu_until", "as_of"):
            if k in kw:
                kw[k] = _as_date(kw[k])
        return replace(self, **kw)


DEFAULT = Config()
