"""The command line."""

from __future__ import annotations

import json

import pytest

from dockside.__main__ import main
from dockside.plans.datasets import breakout_spec, inbound_spec
from dockside.session import scratch_path
from dockside.sinks.tables import read_final, read_staging
from dockside.sources.inputs import TABLE_COLUMNS


def report_of(capsys, *arguments):
    code = main(list(arguments))
    return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_tables_and_sample_runs(spark, database, capsys):
    code, report = report_of(capsys, "create-tables", "--database", database)
    assert code == 0 and len(report["created_tables"]) == 4
    code, report = report_of(capsys, "run", "--database", database, "--samples", "--as-of", "2024-01-30")
    assert code == 0 and report["status"] == "success"
    assert read_final(spark, database, breakout_spec()).count() == 3
    code, report = report_of(
        capsys, "run", "--database", database, "--samples", "--dataset", "po", "--append-only", "--as-of", "2024-01-30"
    )
    assert list(report["results"]) == ["po"] and report["use_merge"] is False
    assert read_staging(spark, database, inbound_spec()).count() == 6
    assert read_final(spark, database, inbound_spec()).count() == 3


def test_run_over_files(spark, database, tables, tmp_path, capsys):
    src = tables()
    refs = {}
    for name in TABLE_COLUMNS:
        path = scratch_path(spark, "raw")
        getattr(src, name).write.parquet(path)
        refs[name] = {"kind": "parquet", "location": path}
    sources = tmp_path / "tables.json"
    sources.write_text(json.dumps(refs))
    fixed = ["run", "--database", database, "--sources", str(sources), "--as-of", "2024-01-30", "--fixed-window"]
    code, report = report_of(capsys, *fixed, "--start-date", "2024-01-01", "--end-date", "2024-01-31")
    assert code == 0 and report["end_date"] == "2024-01-31"
    assert {name: r["status"] for name, r in report["results"].items()} == {"po": "success", "breakout": "no_data"}
    refs["pohdr"]["location"] = refs["potype"]["location"]
    sources.write_text(json.dumps(refs))
    with pytest.raises(Exception, match="po_man"):
        main(fixed)
    with pytest.raises(SystemExit):
        main(["run", "--database", database])
