from __future__ import annotations

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Documents from texts or (doc_id, text) or (doc_id, text, source) rows, over three partitions."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, source = (*row, "src0")[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        fields = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, fields).repartition(3)

    return build
