import pytest

# Columns named like results and internal ones; operators must not trip over them.
CLASHING = ["score", "kept", "node", "bucket", "label", "gram", "rule", "n_words", "class_id", "mix_slot"]


@pytest.fixture
def documents(spark):
    """Documents with extra columns; rows are (doc_id, text) with more on demand."""

    def make(rows, lang="en", source="s"):
        full = [(i, t, lang if len(r) < 1 else r[0] if r else lang, r[1] if len(r) > 1 else source, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, *r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)).repartition(3)

    return make
