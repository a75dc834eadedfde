"""Schemas of the three feeds and of the register of expected breaks."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ["entity", "product", "quarter"]
PRODUCT = "product"
PERIOD = "quarter"

MONEY = T.DecimalType(18, 2)


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in columns])


_ACCOUNT = [(key, T.StringType()) for key in KEYS]

GENERAL_LEDGER = _schema(
    *_ACCOUNT,
    ("gl_balance", MONEY),
    ("gl_account", T.StringType()),
    ("as_of_date", T.DateType()),
)

# loan_id is not a key: a replayed batch brings the same loan twice, and that
# is one of the defects to be found, so the load must not reject it.
SUB_LEDGER = _schema(
    ("loan_id", T.StringType()),
    *_ACCOUNT,
    ("loan_amount", MONEY),
    ("load_batch_id", T.StringType()),
)

REGULATORY_EXTRACT = _schema(
    *_ACCOUNT,
    ("extract_balance", MONEY),
    ("schedule_code", T.StringType()),
    ("extract_run_date", T.DateType()),
)

REGISTER = _schema(
    ("break_id", T.StringType()),
    *_ACCOUNT,
    ("break_type", T.StringType()),
    ("detected_by", T.StringType()),
    ("expected_direction", T.StringType()),
    ("expected_root_cause", T.StringType()),
    ("planted_variance", MONEY),
    ("planted_variance_pct", T.DoubleType()),
    ("notes", T.StringType()),
)

FEEDS = {
    "general_ledger": GENERAL_LEDGER,
    "sub_ledger": SUB_LEDGER,
    "regulatory_extract": REGULATORY_EXTRACT,
}
