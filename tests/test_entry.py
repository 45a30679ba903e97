import subprocess
import sys
import textwrap


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_llm(tmp_path):
    """Without subpackage llm and the pipeline the other queries are all there."""
    code = """
        import sys
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name.startswith("tallybridge.llm") or name == "corpus_pipeline":
                    raise ModuleNotFoundError(name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        names = set(e.queries())
        assert len(names) >= 40 and "pipeline" not in names and not [n for n in names if n.startswith("op1_")]
        assert set(e.oracle_sql()) <= names
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, timeout=120)
