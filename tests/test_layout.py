"""The corpus subpackage stands alone: the rest of the library never imports it."""

import ast
import pathlib

import tabforge

ROOT = pathlib.Path(tabforge.__file__).parent


def test_library_does_not_import_the_corpus_operators():
    for path in ROOT.rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else \
                [node.module or "", *(a.name for a in node.names)] if isinstance(node, ast.ImportFrom) else []
            assert not [n for n in names if "llm" in n.split(".") or n == "corpus_pipeline"], path


def test_worker_functions_travel_with_the_job(tmp_path):
    """A session started in another folder, whose workers cannot import the package."""
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from tabforge.session import get_spark\n"
        "from tabforge.operators import classify as M\n"
        "s = get_spark(master='local[2]')\n"
        "df = s.range(40).selectExpr('id', 'cast(id as double) as a', 'cast(id %% 2 as double) as label')\n"
        "df = M.assemble(df, ['a'])\n"
        "m = M.train_svm(df, ['id'], n_landmarks=5, max_iter=5)\n"
        "m.write().overwrite().save(sys.argv[1])\n"
        "from pyspark.ml import PipelineModel\n"
        "print(PipelineModel.load(sys.argv[1]).transform(df).count())\n" % str(ROOT.parent))
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code, str(tmp_path / "svm")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert got.stdout.strip().endswith("40"), got.stderr[-2000:]
