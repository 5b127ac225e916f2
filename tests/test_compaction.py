import datetime as dt
import os

import pytest
from conftest import bars, raw_frame

from barlake.functions import to_bars
from barlake.operators import append_bars, compact_months, create_bar_table
from barlake.sources import quarantine_bars

JANUARY, FEBRUARY = dt.date(2023, 1, 1), dt.date(2023, 2, 1)


def append(spark, table, *times, symbol="A"):
    rows = raw_frame(spark, [(symbol, t[:4], t[5:7], t, float(i)) for i, t in enumerate(times)])
    append_bars(spark, table, to_bars(rows))


@pytest.fixture
def scattered(spark, make_table):
    """Two files for January, one for February."""
    table = make_table()
    append(spark, table, "2023-01-02 00:00", "2023-02-02 00:00")
    append(spark, table, "2023-01-01 00:00")
    return table


def files(spark, table, month):
    return [f for f in spark.table(table).inputFiles() if f"={month}" in f]


def test_small_files_become_one_in_time_order(spark, scattered):
    before, february = bars(spark.table(scattered)), files(spark, scattered, FEBRUARY)
    assert compact_months(spark, scattered) == [(JANUARY,)]
    assert bars(spark.table(scattered)) == before
    assert len(files(spark, scattered, JANUARY)) == 1 and files(spark, scattered, FEBRUARY) == february
    times = [r[0] for r in spark.read.parquet(*files(spark, scattered, JANUARY)).select("event_time").collect()]
    assert times == sorted(times) and compact_months(spark, scattered) == []


def test_months_larger_than_a_file_need_many_files(spark, scattered):
    assert compact_months(spark, scattered, file_bytes=1) == []
    for day in range(3, 9):  # eight files for January
        append(spark, scattered, f"2023-01-0{day} 00:00")
    before = bars(spark.table(scattered))
    total = sum(os.path.getsize(f.removeprefix("file:")) for f in files(spark, scattered, JANUARY))
    assert compact_months(spark, scattered, file_bytes=total // 2 - 1) == []  # eight files where three are needed
    assert compact_months(spark, scattered, file_bytes=total // 2 + 1) == [(JANUARY,)]  # where two are
    assert bars(spark.table(scattered)) == before


def test_large_months_are_cut_by_adaptive_execution(spark, scattered, monkeypatch):
    from barlake.operators import compaction

    monkeypatch.setattr(compaction, "_SLACK", 0)
    before = bars(spark.table(scattered))
    assert compact_months(spark, scattered, file_bytes=1) == [(JANUARY,), (FEBRUARY,)]
    assert bars(spark.table(scattered)) == before and len(files(spark, scattered, JANUARY)) == 1


def test_only_asked_months_and_none_of_an_empty_table(spark, scattered, make_table):
    assert compact_months(spark, scattered, [FEBRUARY, dt.date(2030, 1, 1)]) == []
    assert compact_months(spark, scattered, [JANUARY]) == [(JANUARY,)]
    assert compact_months(spark, make_table()) == []


def test_buckets_and_rows_without_a_time(spark, tmp_path):
    table = "bars_test.compact_buckets"
    create_bar_table(spark, table, str(tmp_path / "b"), with_symbol=True, symbol_buckets=2)
    for close in (1.0, 2.0):
        rows = [(s, "2023", "01", t, close) for s in "ABCD" for t in ("2023-01-01 00:00", None)]
        append_bars(spark, table, to_bars(raw_frame(spark, rows)))
    before = sorted(map(str, spark.table(table).collect()))
    done = compact_months(spark, table)
    assert {p[0] for p in done} == {JANUARY, None}
    assert sorted(map(str, spark.table(table).collect())) == before
    assert len(spark.table(table).inputFiles()) == len(done) and compact_months(spark, table) == []


def test_bad_rows_are_set_apart_with_their_reason(spark, tmp_path):
    good = "1672531200000,1,2,0.5,1,10,1672531259999,20,3,4,5,0"
    lines = [good, good + ",9", good.rpartition(",")[0], good.replace("0.5", "high"), good.partition(",")[2].join([",", ""]), "", good[:-1] + '"0,1"']
    (tmp_path / "x.csv").write_text("\n".join(lines))
    checked = quarantine_bars(spark, str(tmp_path / "x.csv"))
    assert sorted(r["ignore"] for r in checked.good.collect()) == ["0", "0,1"]
    rejects = {r["text"]: r["reason"] for r in checked.rejects.collect()}
    assert [rejects.pop(x) for x in lines[1:4]] == ["fields", "fields", "value"]
    assert list(rejects.values()) == ["time"] and checked.rejects.filter("file LIKE '%x.csv'").count() == 4


def test_no_rows_give_no_rejects(spark, tmp_path):
    (tmp_path / "x.csv").write_text("")
    checked = quarantine_bars(spark, str(tmp_path / "x.csv"))
    assert checked.good.count() == 0 == checked.rejects.count()
