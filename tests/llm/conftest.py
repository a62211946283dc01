import pytest

TEXT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A table from texts (ids from 0), or from (id, text) pairs."""

    def make(rows, parts=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", f"s{(i or 0) % 3}", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, TEXT).repartition(parts)

    return make


#: Texts that every operator must stand: nothing, white space, marks, repeats, ties, long ones.
ODD = [None, "", " \n\t ", "x", "é" * 40, "漢字 かな", "a b c d e", "a b c d e", "word " * 3000, "z" * 2000, " ", "!!! ???", "\U0001f600 smile", "A\x0bB\x0cC", "same", "same"]
