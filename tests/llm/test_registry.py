def test_thirteen_operators_and_the_pipeline():
    import __spark_entry__ as entry
    names = [k for k in entry.queries() if k.startswith("op") or k == "pipeline"]
    assert sorted(int(k[2:].split("_")[0]) for k in names if k != "pipeline") == list(range(1, 14)) and "pipeline" in names


def test_nothing_else_imports_the_subpackage():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[2]
    for p in [*(root / "trackcast").rglob("*.py"), root / "bench.py", *(root / "tools").rglob("*.py")]:
        if "llm" not in p.relative_to(root).parts:
            assert "trackcast.llm" not in p.read_text(), p
