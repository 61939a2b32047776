"""The whole way from landed pages to checked data, through the command line."""

from __future__ import annotations

import json
from datetime import date

from helpers import MWH, region

from gridmart.jobs import main
from gridmart.plans import dashboard
from gridmart.operators.cleaning import rejected_rows
from gridmart.plans.warehouse import Warehouse
from gridmart.schemas import AUTHORITY_SEED_COLUMNS, FEEDS
from gridmart.sources.landing import by_run_day, land, read_landed

SEED = ",".join(AUTHORITY_SEED_COLUMNS) + """
1,AAA,"Alpha, Inc.",Central,N,North,No,No,Yes,Yes,1900-01-01,9999-12-31,40,-100
2,BBB,Beta,Central,S,South,No,No,Yes,Yes,1900-01-01,9999-12-31,30,-90
""" + ",".join(["-1", *["Unknown"] * 9, "1900-01-01", "9999-12-31", "", ""]) + "\n"
ROWS = {
    "region": [("AAA", "D", "100"), ("BBB", "DF", "80")],
    "fuel_type": [("AAA", "SUN", "40"), ("US48", "SUN", "999")],
    "interchange": [("AAA", "BBB", "-7"), ("AAA", "BBB", "-7")],
}


def _write_page(root, feed, day, total=None):
    rows = ROWS[feed.name]
    data = [
        dict(zip(feed.raw_columns, (f"{day}T05", code, code, series, series, value, MWH), strict=True))
        for code, series, value in rows
    ]
    folder = root / feed.route / f"day={day}"
    folder.mkdir(parents=True)
    page = {"response": {"total": total or str(len(rows)), "data": data}}
    (folder / "page.json").write_text(json.dumps(page))


def test_pages_to_checked_star(spark, tmp_path, capsys):
    pages, landing, house = tmp_path / "pages", str(tmp_path / "landing"), str(tmp_path / "house")
    seed = tmp_path / "seed.csv"
    seed.write_text(SEED)
    for feed in FEEDS.values():
        _write_page(pages, feed, "2024-01-01")
        where = ["--feed", feed.name, "--landing", landing]
        assert main(["land", *where, "--pages", str(pages), "--first", "2024/01/01"], spark) == 0
        for _ in range(2):
            assert main(["stage", *where, "--warehouse", house, "--first", "2024/01/01"], spark) == 0
    assert main(["seed", "--authorities", str(seed), "--warehouse", house], spark) == 0
    assert main(["build", "--warehouse", house], spark) == 0
    assert main(["check", "--warehouse", house], spark) == 0
    assert len(capsys.readouterr().out.strip().split("\n")) >= 30

    day = date(2024, 1, 1)
    row = dashboard.timeseries(Warehouse(spark, house).star(), day, day).first()
    assert tuple(row)[3:] == (100, 80, -7, 40)

    region = FEEDS["region"]
    _write_page(pages, region, "2024-01-02")
    where = ["--feed", "region", "--landing", landing]
    assert main(["land", *where, "--pages", str(pages), "--first", "2024/01/02"], spark) == 0
    stream = ["--warehouse", house, "--checkpoint", str(tmp_path / "progress")]
    assert main(["stream", *where, *stream, "--files-per-batch", "1"], spark) == 0
    days = ["--first", "2024/01/02", "--last", "2024/01/03"]
    assert main(["refresh", "--warehouse", house, *days], spark) == 0
    rows = dashboard.timeseries(Warehouse(spark, house).star(), day, date(2024, 1, 3)).collect()
    assert [r["demand"] for r in rows] == [100, 100]
    capsys.readouterr()
    assert main(["check", "--warehouse", house, *days], spark) == 0
    assert len(capsys.readouterr().out.strip().split("\n")) == 30


def test_an_incomplete_run_replaces_nothing(spark, tmp_path, capsys):
    landing, region = str(tmp_path / "landing"), FEEDS["region"]
    where = ["land", "--feed", "region", "--landing", landing, "--first", "2024/01/01", "--last", "2024/01/03"]
    whole, short = tmp_path / "whole", tmp_path / "short"
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        _write_page(whole, region, day)
    assert main([*where, "--pages", str(whole)], spark) == 0
    _write_page(short, region, "2024-01-01", total="3")
    _write_page(short, region, "2024-01-02")
    twice = short / region.route / "day=2024-01-02"
    (twice / "again.json").write_text((twice / "page.json").read_text())
    capsys.readouterr()
    assert main([*where, "--pages", str(short)], spark) == 1
    told = capsys.readouterr().out
    assert "2024-01-01 not landed: 2 of 3 rows" in told and "2024-01-03 not landed: 0 of None rows" in told
    kept = read_landed(spark, landing, region).groupBy("day").count().collect()
    assert {r["count"] for r in kept} == {2} and len(kept) == 3


def test_unreadable_rows_reach_the_count(spark, tmp_path, capsys):
    records = region(spark, ("2024-01-01T05", "A", "D", "1"), ("bad", "A", "D", "1"), ("2024-01-01T06", "A", "D", "x"))
    landing, house = str(tmp_path / "landing"), str(tmp_path / "house")
    first = date(2024, 1, 1)
    land(by_run_day(records, FEEDS["region"], first, first), landing, FEEDS["region"])
    assert rejected_rows(read_landed(spark, landing, FEEDS["region"]), FEEDS["region"]).first()["rejected_rows"] == 2
    stage = ["stage", "--feed", "region", "--landing", landing, "--warehouse", house, "--first", "2024/01/01"]
    assert main(stage, spark) == 0
    assert capsys.readouterr().out.strip() == "region 2 rows rejected"
