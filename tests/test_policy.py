"""The library stays on the JVM path: no Python UDFs, no RDD processing, no collect in data paths."""

import pathlib
import re

PACKAGE = pathlib.Path(__file__).resolve().parents[1] / "verdant"

FORBIDDEN = {
    "python udf": re.compile(r"\b(F\.)?(pandas_)?udf\s*\(|@udf|@pandas_udf|applyInPandas|mapInPandas"),
    "rdd processing": re.compile(r"\.rdd\.(map|flatMap|filter|reduce|collect|foreach)|mapPartitions"),
    "collect to the driver": re.compile(r"\.(collect|toPandas|toLocalIterator)\s*\("),
    "local checkpoint": re.compile(r"localCheckpoint"),
}


def test_no_forbidden_calls_in_the_library():
    found = []
    for path in PACKAGE.rglob("*.py"):
        if path.parent.name == "llm":  # its operators choose their style one by one
            continue
        for i, line in enumerate(path.read_text().splitlines(), 1):
            code = line.split("#", 1)[0]
            for what, pattern in FORBIDDEN.items():
                if pattern.search(code):
                    found.append(f"{path.relative_to(PACKAGE.parent)}:{i}: {what}: {line.strip()}")
    assert not found, "\n".join(found)
