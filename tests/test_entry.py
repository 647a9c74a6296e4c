import __spark_entry__ as entry


def test_queries_and_sql_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 40


def test_entry_runs_from_any_folder(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    row = entry.entry(spark).first()
    assert row.parsed == row.duplicates + row.stored > 0
