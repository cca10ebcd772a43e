import __spark_entry__ as entry


def test_entry_and_contract(spark, data):
    df = entry.entry(spark)
    assert df.columns == ["year", "n", "share_opposed", "share_supported"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_stands_alone():
    """Nothing outside the subpackage imports it."""
    from pathlib import Path

    root = Path(entry.__file__).parent / "hearthline"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "hearthline.llm" not in f.read_text()
