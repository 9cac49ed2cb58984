"""Source-level guards for the scale policies of the library code."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "riskspark"
LIBRARY = [p for p in ROOT.rglob("*.py") if "testing" not in p.parts and "llm" not in p.parts]


def _hits(pattern: str) -> list[str]:
    rx = re.compile(pattern)
    return [f"{p.relative_to(ROOT)}:{i}" for p in LIBRARY
            for i, line in enumerate(p.read_text().splitlines(), 1) if rx.search(line)]


def test_broadcast_hints_only_on_the_bounded_calendar():
    assert sorted(_hits(r"F\.broadcast\(")) == [
        "operators/intervals.py:%d" % _line("operators/intervals.py", "F.broadcast(cal_pieces)"),
        "operators/sweep.py:%d" % _line("operators/sweep.py", "F.broadcast(self._days)")]


def _line(rel: str, text: str) -> int:
    for i, line in enumerate((ROOT / rel).read_text().splitlines(), 1):
        if text in line:
            return i
    raise AssertionError(text)


def test_no_forbidden_constructs():
    assert _hits(r"localCheckpoint|crossJoin|\.rdd\b|mapPartitions|F\.udf|pandas_udf") == []
    assert _hits(r"coalesce\(1\)|repartition\(1\)") == []


def test_collect_only_for_catalog_metadata_and_changed_days():
    assert sorted(_hits(r"\.collect\(\)|\.toPandas\(\)|\.toArrow\(\)")) == [
        "plans/mart.py:%d" % _line("plans/mart.py", "changed.collect()"),  # one row a payment day, while publishing
        "sinks.py:%d" % _line("sinks.py", 'SHOW TABLES')]


def test_no_job_while_a_plan_is_built():
    jobs = _hits(r"\.(first|head|tail|isEmpty|count|toLocalIterator)\(\)|\.(take|show|foreach)\(")
    assert [h for h in jobs if h.startswith(("plans/", "operators/", "functions/"))] == []
