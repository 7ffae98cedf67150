"""What the training-data operators may and may not use."""

import re
from pathlib import Path

from tidemark.llm import queries

FOLDER = Path(queries.__file__).parent
#: Rows that come to the driver, by file, with what bounds their number.
COLLECTED = {
    "lattice_lm.py": 2,  # one row for each piece of the vocabulary; at most 20,000 frequent words
    "quality_rules.py": 1,  # at most 20,000 rows of the references
}
#: The secondary-sort shuffle of a few pairs for each anchor.
RDDS = {"hard_negatives.py": 1}


def test_what_does_not_scale():
    for path in FOLDER.glob("*.py"):
        text = path.read_text()
        for banned in ("localCheckpoint", "crossJoin", "toLocalIterator", "F.udf(", "broadcast("):
            assert banned not in text, (path.name, banned)
        assert len(re.findall(r"\.collect\(|\.toPandas\(", text)) == COLLECTED.get(path.name, 0), path.name
        assert len(re.findall(r"\.rdd\b", text)) == RDDS.get(path.name, 0), path.name


def test_native_operator_uses_no_python_workers():
    text = (FOLDER / "url_filters.py").read_text()
    for banned in ("pandas", "Arrow", "udf", ".rdd"):
        assert banned not in re.sub(r'""".*?"""', "", text, flags=re.S), banned
