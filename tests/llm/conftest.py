import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tidemart.llm.tables import ship  # noqa: E402

TEXTS = [
    None, "", " \n\t ", "a", "İ ß ﬁ 中文", "\x00\x01 nul", "▁ literal ▁▁ marks  and   spaces ", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"",
    "word " * 400, "aaaa" * 300, "The quick brown fox jumps over the lazy dog. " * 12,
]


@pytest.fixture(scope="session")
def shipped(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def odd_documents(shipped):
    """Null, empty, tied and repeated rows, a null id, and columns with clashing names."""
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, ""][i % 4], i) for i, t in enumerate(TEXTS)]
    rows += [(50, TEXTS[-1], "en", "a", 1), (50, TEXTS[-1], "en", "a", 1), (50, "another text with the same id", "en", "a", 1), (None, "no id", "de", "a", 0), (None, None, None, None, None)]
    columns = ", ".join(f"`{c}` int" for c in ("id", "key", "sha", "size", "place", "token", "n", "marks", "copies", "found", "v", "leaf"))
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {columns}"
    return shipped.createDataFrame([r + (0,) * 12 for r in rows], schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
