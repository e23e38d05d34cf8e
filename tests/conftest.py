import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from daybook.session import build_session  # noqa: E402

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "daybook-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="100000",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(home / "checkpoint"),
        spark__sql__warehouse__dir=str(home / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip(f"no test tables in {DATA}")
    return str(DATA)


@pytest.fixture
def rows_of():
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return collect


@pytest.fixture
def make_tx(spark):
    """Transactions from short rows; what is not given has a plain value."""
    from datetime import datetime
    from decimal import Decimal

    from daybook.schemas import TRANSACTIONS

    base = {
        "merchant_account_id": 9,
        "merchant_name": "Shop",
        "mid": 1,
        "amount": 5000,
        "refunded_amount": 0,
        "status": "succeeded",
        "transaction_type": "charge",
        "transaction_date": "2024-01-10 12:00:00",
        "updated_at": "2024-01-10 12:00:00",
    }

    def build(*rows):
        out = []
        for n, given in enumerate(rows):
            row = {"transaction_uuid": f"u{n}", **base, **given}
            for c in ("amount", "refunded_amount"):
                row[c] = None if row[c] is None else Decimal(row[c])
            for c in ("transaction_date", "updated_at", "SourceAccountCreated"):
                if isinstance(row.get(c), str):
                    row[c] = datetime.fromisoformat(row[c])
            out.append(tuple(row.get(f.name) for f in TRANSACTIONS))
        return spark.createDataFrame(out, TRANSACTIONS)

    return build
