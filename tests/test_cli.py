from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tidemark import schemas
from tidemark.__main__ import main, parser
from tidemark.plans.lake import Lake


def test_check_reports_the_verdict_and_latest_shows_rows(spark, tmp_path, capsys):
    root = str(tmp_path / "lake")
    lake = Lake(spark, root, "UTC")
    start = datetime(2100, 1, 1)
    row = (start, start + timedelta(minutes=1))
    lake.append(spark.createDataFrame([(*row, "orders_created", 1.0, None)],
                schemas.table_schema("gold.commerce_kpis_1m")), "gold.commerce_kpis_1m", "w", 0)
    common = ["--root", root, "--zone", "UTC"]
    assert main(["check", *common, "--run-id", "1"]) == 1
    assert "success=False" in capsys.readouterr().out
    lake.append(spark.createDataFrame([(*row, "BTC-USD", "vwap_1m", 1.0, None)],
                schemas.table_schema("gold.crypto_market_kpis_1m")),
                "gold.crypto_market_kpis_1m", "w", 0)
    assert main(["check", *common, "--run-id", "2"]) == 0
    assert "success=True" in capsys.readouterr().out
    assert main(["latest", *common, "--table", "gold.commerce_kpis_1m"]) == 0
    assert "orders_created" in capsys.readouterr().out
    assert main(["snapshots", *common, "--table", "gold.commerce_kpis_1m"]) == 0
    assert "w-0" in capsys.readouterr().out
    entry = ("orders_rows", "r", 0, start, 1, 41, 40, None, 0, 0)
    lake.append(spark.createDataFrame([entry], schemas.table_schema("ops.job_batches")),
                "ops.job_batches", "log", 0)
    assert main(["accounts", *common]) == 0
    assert "orders_rows" in capsys.readouterr().out


def test_arguments():
    args = parser().parse_args(["stream", "--root", "/r", "--servers", "b:9092"])
    assert args.zone == "Asia/Seoul" and "behavior" not in args.feeds
    with pytest.raises(SystemExit):
        parser().parse_args(["stream", "--root", "/r"])
