"""The library does without its subpackage for corpora."""

import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_else_imports_llm():
    for path in (ROOT / "quire").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("quire.llm") for n in names), path


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
