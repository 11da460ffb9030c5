import random
import uuid

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Texts to a documents table; ids from 0 unless pairs are given."""

    def make(*texts, extra=()):
        rows = []
        for k, item in enumerate(texts):
            doc_id, text = item if isinstance(item, tuple) else (k, item)
            rows.append((doc_id, text, "en", f"src{k % 3}", len(text) if text else 0, *(["x"] * len(extra))))
        return spark.createDataFrame(rows, DOCS + "".join(f", {name} string" for name in extra))

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of random words with copies, near copies, shared lines, blanks and nulls."""
    random.seed(5)
    vocabulary = [f"w{k}ord" for k in range(60)] + ["Été", "straße", "naïve"]
    shared = [" ".join(random.choices(vocabulary, k=9)) for _ in range(6)]
    texts = []
    for k in range(120):
        lines = [" ".join(random.choices(vocabulary, k=random.randint(1, 30))) for _ in range(random.randint(1, 5))]
        if k % 3 == 0:
            lines.insert(random.randint(0, len(lines)), random.choice([" ", ""]) + random.choice(shared).upper())
        texts.append("\n".join(lines))
    texts += texts[:10] + [t.replace(" ", "  ", 2) for t in texts[10:20]] + [t + " tail" for t in texts[20:30]]
    return [*texts, "", " \n\t", None, None, "a", "long " * 40_000]


@pytest.fixture
def fixture_dir(tmp_path):
    """Write frames as the tables of a data folder."""

    def make(**frames):
        folder = str(tmp_path / uuid.uuid4().hex)
        for name, frame in frames.items():
            frame.write.parquet(f"{folder}/{name}.parquet")
        return folder

    return make
