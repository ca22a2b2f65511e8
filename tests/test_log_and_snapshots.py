import logging

from granary.log import ZoneFormatter, logger_to
from granary.operators.snapshots import indicators, refreshed


def test_log_lines_bear_the_zones_time(tmp_path):
    for name in ("a", "b"):  # asked for twice, a line is written once
        log = logger_to(str(tmp_path / "logs" / f"{name}.log"), "weather")
        log.info("loaded %d rows", 3)
    lines = (tmp_path / "logs" / "b.log").read_text().splitlines()
    assert len(lines) == 1 and lines[0].endswith(" - INFO - loaded 3 rows") and lines[0][19:22] in ("+01", "+02")
    record = logging.LogRecord("x", logging.WARNING, "", 0, "hot", None, None)
    record.created = 1720000000.0
    assert ZoneFormatter().format(record) == "2024-07-03 11:46:40+02:00 - WARNING - hot"
    record.created = 1704067199.0
    assert ZoneFormatter("America/New_York").format(record).startswith("2023-12-31 18:59:59-05:00")


def test_refresh_keeps_notes_and_tells_what_changed(spark):
    old = spark.createDataFrame([(1, 10, "a", "k"), (2, 10, "b", None), (2, 20, "c", None), (3, 10, "d", None), (None, 10, "z", None), (5, None, "e", None)], "id int, v int, note string, held string")
    new = spark.createDataFrame([(1, 10, None, "x", ""), (2, 30, " ", None, None), (3, 10, "own", "x", "y"), (4, 10, None, None, "y"), (None, 10, None, None, None), (5, None, "", None, None)], "id int, v int, note string, p string, q string")
    out = refreshed(old, new, "id", "v", ["note", "held"])
    got = {r["id"]: (r["note"], r["held"], r["status"]) for r in out.collect()}
    assert got == {1: ("a", "k", "unchanged"), 2: ("c", None, "modified"), 3: ("own", None, "unchanged"), 4: (None, None, "new"), None: (None, None, "new"), 5: ("e", None, "unchanged")}
    assert tuple(indicators(out, "v", "p", "q").first()) == (6, 2, 1, 30, 2)
    assert tuple(indicators(out.limit(0), "v", "p", "q").first()) == (0, 0, 0, None, 0)
