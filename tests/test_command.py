"""The command line on stored tables."""

import pytest

import run_reports
from tidemark.sources import staffing

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    tables = staffing.stored(spark, FOLDER)
    return tables["salaries"].inputFiles()[0].partition("/salaries.parquet/")[0]


def count(spark, path):
    return spark.read.option("header", True).csv(path).count()


def test_run_and_changes(spark, stored, tmp_path, capsys):
    out = str(tmp_path)
    run_reports.main(["run", "--tables", stored, "--out", out])
    assert count(spark, f"{out}/reports/annual_salary_by_department") == 35
    assert count(spark, f"{out}/reports/job_hoppers") == 148
    assert count(spark, f"{out}/reports/employee_changes") == 300
    assert spark.read.parquet(f"{out}/reports/employee_master").count() == 150
    april = ["changes", "--tables", f"{out}/tables", "--out", f"{out}/april"]
    run_reports.main([*april, "--month-before", "2000-05-01"])
    assert count(spark, f"{out}/april/employee_changes") == 104
    run_reports.main([*april, "--start", "2000-04-01", "--end", "2000-04-30"])
    assert count(spark, f"{out}/april/employee_changes") == 104
    assert "employee_changes: " in capsys.readouterr().out
    with pytest.raises(ValueError):
        run_reports.main([*april, "--start", "2000-04-01"])


def test_one_source_is_needed():
    for source in ([], ["--tables", "a", "--url", "b"]):
        with pytest.raises(SystemExit):
            run_reports.parse(["run", "--out", "x", *source])
