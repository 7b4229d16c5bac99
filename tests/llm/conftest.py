import pytest

ODD = [None, "", " \n\t ", "one two", "A<|endoftext|>b 's don't É é", "x" * 3000, "1 " * 4000 + "9", "a.a" * 800 + "@b.co.uk"]


@pytest.fixture
def documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, a null id and columns with names the operators use."""

    def make(texts):
        rows = [(i, t, "mine", 1, "z") for i, t in texts]
        return spark.createDataFrame(rows, "doc_id long, text string, _spans string, v int, `key` string")

    return make
